"""Jaccard join of word n-gram sets by R-trees over count vectors (op12).

A set's tokens (hashed n-grams) are dealt to groups by hash; the counts per group are its point. Two sets
share at most the sum of the coordinate minima of their points, and a set shares at most the sum of the minima
with a box's upper corner with any set in that box. So an R-tree answers "which sets may be similar enough to
x", and only the pairs that survive are compared token by token.

One tree cannot hold all sets, so trees are grown where similar sets must meet. Similar sets differ in at most
``R = 3 (|a| + |b|) / 37`` tokens (at 85 percent). Hash space is cut into more than R slices, so in
one slice at least the two points agree in every coordinate: sets that agree in a slice, by a hash of its
group counts, meet in a cell. Sizes are cut into classes, each with its own number of slices; a set that may be
similar to one of the next class has that class's cells too. Where so many slices are empty that these alone
could agree, empty ones count too.

1. one pass over the texts writes each document's set size, set signature, point and cells;
2. documents with equal sets share a tag, the hash of their set signature, and a representative; cells that hold two tags
   or more are kept. (cell, tag) pairs are gathered as packed arrays, from where the cells were made; of a cell that many of
   a batch share, one pair of the batch is moved and the others are known to be shared, so a cell that all share stays
   small. Tags of shared cells are then looked up, and the points of the representatives that they stand for;
3. a cell's hub is its most central member; each representative is compared, by points, fine points and then set by set, with
   the hub that it shares most cells with: the verified links make a first set of components, in which large groups come together;
4. a cell all of one component is settled. In the others, members outside the largest component meet
   all members, in blocks of bounded rows: R-tree search by points gives pairs that may be links;
5. components that such pairs may join form a group; in it the members outside its largest component
   meet all members in blocks of bounded bytes: R-tree search, and for its finds the bound by finer points, whose
   coordinates grow with the sets. The groups that these leave are searched once more, and the sets decide;
6. components of all verified links, brought back to the copies. Blocks return spanning links only.

Defined results: null or wordless texts have an empty set and link with nothing. Repeated rows are copies
of each other and get equal results; a null doc_id links with nothing (component_id null). Rows of one
doc_id with different texts are each grouped by their own text; if that id stands for both texts' copies, it
also joins their groups. One row comes out for each row. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import adjacent_groups, map_arrow, map_texts
from tagloom.llm.components import components
from tagloom.llm.setsketch import Forest, likely, signatures
from tagloom.session import cut_lineage

SHINGLE_WORDS = 4
PERCENT = 85
GROUPS = 64  # coordinates of a point
FULL = 65535  # a coordinate of this and more counts as unbounded
CLASS_WIDTH = 1.6
PACKED_PAIRS = 1 << 22  # (cell, node) pairs that one task gathers
LEAF, CHILDREN = 32, 8  # points of a leaf page, children of a node
BLOCK_ROWS = 4096
PAIRS = 1 << 15  # pairs of points that are compared at a time
FINE_ROWS = 1 << 10  # pairs of fine points that are held at a time
BLOCK_BYTES = 8 << 20


# --- sets, points and cells -----------------------------------------------------------

def token_sets(values) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct token hashes of each text, one after the other, and the bounds of each text's set."""
    data, offsets = textvec.flat(values)
    return textvec.shingle_sets(textvec.words(textvec.LOWER[data], offsets), SHINGLE_WORDS)


def points(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Group counts (one row for each set), as 16-bit numbers that stop at FULL."""
    n = len(bounds) - 1
    at = np.repeat(np.arange(n), np.diff(bounds)) * GROUPS + (sets % np.uint64(GROUPS)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n * GROUPS), FULL).astype(np.uint16).reshape(n, GROUPS)


def fine_groups(size: int) -> int:
    """Coordinates of a set's fine point: a power of two of about a quarter of its size, GROUPS at least."""
    return max(GROUPS, 1 << (-(-size // 4) - 1).bit_length()) if size else GROUPS


def fine_points(sets: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Fine group counts of each set, as bytes that stop at 255; folding them in halves gives those of fewer groups."""
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        groups = fine_groups(b - a)
        out.append(np.minimum(np.bincount((sets[a:b] % np.uint64(groups)).astype(np.int64), minlength=groups), 255).astype(np.uint8).tobytes())
    return out


class FinePoints:
    """Fine points of the rows of a block, compared at the resolution of the coarser of two."""

    def __init__(self, column):
        rows = [np.frombuffer(b, dtype=np.uint8).astype(np.int32) for b in column.to_pylist()]
        self.groups = np.array([len(r) for r in rows])
        self.at = np.zeros(len(rows), dtype=np.int64)  # a row's place among those of its resolution
        self.folded = {}
        for g in np.unique(self.groups).tolist():
            own = np.flatnonzero(self.groups == g)
            self.at[own] = np.arange(len(own))
            full = np.stack([rows[i] for i in own])
            full[full == 255] = 1 << 30
            self.folded[g, g] = full

    def _at(self, of: int, groups: int) -> np.ndarray:
        if (of, groups) not in self.folded:
            full = self.folded[of, of].astype(np.int64)
            self.folded[of, groups] = np.minimum(full.reshape(len(full), -1, groups).sum(axis=1), 1 << 30).astype(np.int32)
        return self.folded[of, groups]

    def shared(self, x: int, ys: np.ndarray) -> np.ndarray:
        """The most tokens that set x can share with each of ys, by the summed minima."""
        out = np.zeros(len(ys), dtype=np.int64)
        of = int(self.groups[x])
        for g in np.unique(self.groups[ys]).tolist():
            rows, level = self.groups[ys] == g, min(g, of)
            out[rows] = np.minimum(self._at(g, level)[self.at[ys[rows]]], self._at(of, level)[self.at[x]]).sum(axis=1, dtype=np.int64)
        return out


def unpacked(column) -> np.ndarray:
    """Points of a binary column; FULL coordinates become larger than any set."""
    p = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, GROUPS).astype(np.int64)
    p[p == FULL] = 2**40
    return p


def size_classes(largest: int) -> np.ndarray:
    """Least sizes of the classes, each about CLASS_WIDTH times the last."""
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, int(low[-1] * CLASS_WIDTH)))
    return np.array(low, dtype=np.int64)


def slices_of(label: int, low: np.ndarray) -> tuple[int, int]:
    """(slices, spare) for pairs whose larger set is of a class: more slices than such a pair differs in, and so many to spare."""
    differ = 2 * (100 - PERCENT) * int(low[label + 1] - 1) // (100 + PERCENT)
    spare = 2 + differ // 16
    return differ + 1 + spare, spare


def cells(sets: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Cells of each set: a hash of every slice's group counts, for its size class and, if a similar set may be of it, the next."""
    size = np.diff(bounds)
    low = size_classes(int(size.max(initial=0)) * 2 + 2)
    weight = textvec.mix((sets & np.uint64(0xFFFFFFFF)) + np.uint64(1))  # a token's group within its slice; few groups would meet by chance
    out = []
    for i, n in enumerate(size.tolist()):
        own, largest = [], n * 100 // PERCENT
        if largest > n:  # sets smaller than that are similar to equal ones only
            tokens, w = sets[bounds[i] : bounds[i + 1]], weight[bounds[i] : bounds[i + 1]]
            first_label, last_label = (np.searchsorted(low, [n, largest], side="right") - 1).tolist()
            for at in range(first_label, last_label + 1):
                m, spare = slices_of(at, low)
                piece = ((tokens >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # rises with the sorted tokens
                first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
                name, total = piece[first], np.add.reduceat(w, first)
                if m - len(first) > spare:  # so many are empty that only empty ones may agree
                    empty = np.setdiff1d(np.arange(m, dtype=np.uint64), name)
                    name, total = np.concatenate([name, empty]), np.concatenate([total, np.zeros(len(empty), np.uint64)])
                own.append(textvec.mix(total ^ textvec.mix(name + np.uint64((at + 1) << 32))))
        out.append(np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64))
    return out


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, n_bytes, signature, point, fine, cells) of every row of docs."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        values = piece.column("text")
        sets, bounds = token_sets(values)
        own = cells(sets, bounds)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate([*own, np.zeros(0, np.int64)])))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.diff(bounds)), pa.array(np.diff(textvec.flat(values)[1])), pa.array(signatures(sets, bounds), pa.binary()),
             pa.array([p.tobytes() for p in points(sets, bounds)], pa.binary()), pa.array(fine_points(sets, bounds), pa.binary()), lists],
            names=["doc_id", "n_shingles", "n_bytes", "signature", "point", "fine", "cells"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), fn,
                     "doc_id long, n_shingles long, n_bytes long, signature binary, point binary, fine binary, cells array<long>")


# --- the tree -------------------------------------------------------------------------

def similar(shared, a, b):
    """Whether sets of sizes a and b with so many shared tokens link."""
    return (100 + PERCENT) * shared >= PERCENT * (a + b)


class CountTree:
    """R-tree over points, bulk-loaded; a node keeps its box's upper corner and its least and greatest set size."""

    def __init__(self, point: np.ndarray, size: np.ndarray):
        self.order = self._tiled(point, np.arange(len(point)))
        self.point, self.size = point[self.order], size[self.order]
        self.levels = []  # from the pages up: upper corners, least sizes, greatest sizes, children of each node
        corner, least, most, width = self.point, self.size, self.size, LEAF
        while True:
            at = np.arange(0, len(corner), width)
            ends = np.append(at[1:], len(corner))
            corner, least, most = (np.maximum.reduceat(corner, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at))
            self.levels.append((corner, least, most, at, ends))
            if len(corner) <= CHILDREN:
                break
            width = CHILDREN

    @staticmethod
    def _tiled(point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows in an order whose pages are compact: halves by the widest coordinate, over and over."""
        todo, done = [rows], []
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                done.append(rows)
                continue
            widest = int(np.argmax(np.ptp(np.minimum(point[rows], FULL), axis=0)))
            half = -(-len(rows) // (2 * LEAF)) * LEAF  # whole pages
            rows = rows[np.argsort(point[rows, widest], kind="stable")]
            todo += [rows[half:], rows[:half]]
        return np.concatenate(done)

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose set may be similar to one with this point and size."""
        at = np.arange(len(self.levels[-1][0]))
        for corner, least, most, first, end in reversed(self.levels):
            shared = np.minimum(np.minimum(corner[at], point).sum(axis=1), np.minimum(most[at], size))
            at = at[similar(shared, size, least[at])]
            at = _ranges(first[at], end[at])
        shared = np.minimum(self.point[at], point).sum(axis=1)
        shared = np.minimum(shared, np.minimum(self.size[at], size))
        return self.order[at[similar(shared, size, self.size[at])]]


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """first[0]..end[0]-1, first[1]..end[1]-1 and so on."""
    n = end - first
    return np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def joined(left: np.ndarray, right: np.ndarray, point: np.ndarray, size: np.ndarray, component: np.ndarray, check=None) -> list[tuple[int, int]]:
    """Pairs (x of left, y of right) that join components, a spanning forest of the similar pairs.

    Without ``check`` the points decide; check(x, ys) tells which of the candidates are similar.
    """
    if not len(left) or not len(right):
        return []
    names, root = np.unique(component, return_inverse=True)
    forest, out = Forest(len(names)), []
    own = root.copy()  # the present root of each row
    tree = CountTree(point[right], size[right])
    for x in left.tolist():
        ys = right[tree.search(point[x], int(size[x]))]
        ys = ys[own[ys] != own[x]]
        if check is not None and len(ys):
            ys = ys[check(x, ys)]
        if not len(ys):
            continue
        _, one = np.unique(own[ys], return_index=True)  # one link to each tree
        for y in ys[np.sort(one)].tolist():
            forest.link(root[x], root[y])
            out.append((x, y))
        own = np.array([forest.root(i) for i in range(len(names))])[root]
    return out


# --- blocks ---------------------------------------------------------------------------

def _links(first: np.ndarray, second: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(first), pa.array(second)], names=["u", "v"])


def _whole_groups(batches, keys: list[str]):
    """Tables of adjacent rows that hold whole groups of equal keys, about a batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys])
        starts = np.flatnonzero(np.concatenate(([last is None or (k[:, 0] != last).any()], (k[:, 1:] != k[:, :-1]).any(axis=0))))
        last = k[:, -1]
        if len(starts):
            cut = int(starts[-1])
            held.append(batch.slice(0, cut))
            if any(h.num_rows for h in held):
                yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _likely_stars(batches):
    """(node, hub) of the rows whose points, and then fine points, do not rule the pair out."""
    for batch in batches:
        size, hub_size = (batch.column(c).to_numpy() for c in ("n_shingles", "hub_shingles"))
        point, hub_point = unpacked(batch.column("point")), unpacked(batch.column("hub_point"))
        shared = np.minimum(np.minimum(point, hub_point).sum(axis=1), np.minimum(size, hub_size))
        may = batch.filter(pa.array(similar(shared, size, hub_size)))
        for a in range(0, may.num_rows, FINE_ROWS):
            part = may.slice(a, FINE_ROWS)
            size, hub_size = (part.column(c).to_numpy() for c in ("n_shingles", "hub_shingles"))
            fine = FinePoints(pa.concat_arrays([part.column("fine"), part.column("hub_fine")]))
            shared = np.array([fine.shared(x, np.array([x + part.num_rows]))[0] for x in range(part.num_rows)])
            kept = pa.array(similar(np.minimum(shared, np.minimum(size, hub_size)), size, hub_size))
            yield part.select(["node", "hub"]).filter(kept)


def _may_join(batches):
    """(u, v) components that a pair of points in a block may join.

    Blocks of few rows, of which there are many with the same pairs in them, are compared outright by the bound, pairs
    of a batch of blocks at a time and each once; larger ones through a tree each.
    """
    for table in _whole_groups(batches, ["cell", "a", "b"]):
        side, node, component, size = (table[c].to_numpy() for c in ("side", "node", "component", "n_shingles"))
        point = unpacked(table["point"])
        k = np.stack([table[c].to_numpy() for c in ("cell", "a", "b")])
        start = np.flatnonzero(np.concatenate(([True], (k[:, 1:] != k[:, :-1]).any(axis=0))))
        end = np.append(start[1:], len(side))
        middle = start + np.add.reduceat(side == 0, start)  # side 0 comes first
        small = end - start <= 2 * LEAF
        x = _ranges(start[small], middle[small])
        block = np.repeat(np.flatnonzero(small), (middle - start)[small])
        y, x = _ranges(middle[block], end[block]), np.repeat(x, end[block] - middle[block])
        other = component[x] != component[y]
        x, y = x[other], y[other]
        _, name = np.unique(node, return_inverse=True)
        _, once = np.unique(np.minimum(name[x], name[y]) * len(node) + np.maximum(name[x], name[y]), return_index=True)
        x, y = x[once], y[once]
        found = []
        for a in range(0, len(x), PAIRS):
            i, j = x[a : a + PAIRS], y[a : a + PAIRS]
            may = similar(np.minimum(np.minimum(point[i], point[j]).sum(axis=1), np.minimum(size[i], size[j])), size[i], size[j])
            found.append(np.stack([component[i[may]], component[j[may]]]))
        for a, m, b in zip(start[~small], middle[~small], end[~small]):
            for i, j in joined(np.arange(a, m), np.arange(m, b), point, size, component):
                found.append(np.array([[component[i]], [component[j]]]))
        found = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1) if found else np.zeros((2, 0), np.int64)
        if found.size:
            yield _links(found[0], found[1])


def _may_join_finely(batches):
    """(u, v) components of a group that a pair of fine points in a block may join: a spanning forest."""
    for group in adjacent_groups(batches, ["group", "a", "b"]):
        side, component, size = (group[c].to_numpy() for c in ("side", "component", "n_shingles"))
        fine = FinePoints(group["fine"])

        def check(x, ys):
            return similar(np.minimum(fine.shared(x, ys), np.minimum(size[x], size[ys])), size[x], size[ys])

        found = joined(np.flatnonzero(side == 0), np.flatnonzero(side == 1), unpacked(group["point"]), size, component, check)
        if found:
            yield _links(*(component[list(at)] for at in zip(*found)))


def _verified(batches):
    """(u, v) nodes whose sets are similar: a spanning forest over the components in a block."""
    for group in adjacent_groups(batches, ["group", "a", "b"]):
        sets, bounds = token_sets(group["text"])
        own = np.array([x == y for x, y in zip(signatures(sets, bounds), group["signature"].to_pylist())])
        if not own.all():  # another text under the same id
            group = group.filter(pa.array(own))
            sets, bounds = token_sets(group["text"])
        side, node, component = (group[c].to_numpy() for c in ("side", "node", "component"))
        if (side == 0).all() or (side == 1).all():
            continue
        size = np.diff(bounds)

        def check(x, ys):
            at = _ranges(bounds[:-1][ys], bounds[1:][ys])
            mine, theirs = sets[bounds[x] : bounds[x + 1]], sets[at]
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            shared = np.add.reduceat((mine[place] == theirs).astype(np.int64), np.cumsum(size[ys]) - size[ys])
            return similar(shared, size[x], size[ys])

        found = joined(np.flatnonzero(side == 0), np.flatnonzero(side == 1), points(sets, bounds).astype(np.int64), size, component, check)
        if found:
            yield _links(*(node[list(at)] for at in zip(*found)))


def _sorted_pairs(cell: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs by cell and node: copies bring the same ones."""
    order = np.lexsort((node, cell))
    cell, node = cell[order], node[order]
    new = np.concatenate((np.ones(min(len(cell), 1), bool), (cell[1:] != cell[:-1]) | (node[1:] != node[:-1])))
    return cell[new], node[new]


def _packed(parts: int):
    """Rows (part, cells, nodes) of each batch: packed pairs dealt by cell, and those that the batch itself shows to be shared.

    The latter have a part of ``parts`` and more; of their cells the least node alone is dealt.
    """

    def fn(batches):
        for batch in batches:
            lists = batch.column("cells")
            cell, node = lists.flatten().to_numpy(), np.repeat(batch.column("node").to_numpy(), lists.value_lengths().to_numpy())
            if not len(cell):
                continue
            cell, node = _sorted_pairs(cell, node)
            first = np.concatenate(([True], cell[1:] != cell[:-1]))
            shared = np.repeat(np.diff(np.append(np.flatnonzero(first), len(cell))) > 1, np.diff(np.append(np.flatnonzero(first), len(cell))))
            for offset, rows in ((0, first), (parts, shared)):
                c, n = cell[rows], node[rows]
                part = (c % parts) + offset
                order = np.argsort(part, kind="stable")
                c, n, part = c[order], n[order], part[order]
                at = np.flatnonzero(np.concatenate((np.ones(min(len(part), 1), bool), part[1:] != part[:-1])))
                ends = np.append(at[1:], len(part))
                yield pa.RecordBatch.from_arrays([pa.array(part[at]), *(pa.array([v[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()) for v in (c, n))],
                                                 names=["part", "cells", "nodes"])

    return fn


def _shared(parts: int):
    """(cell, node) pairs of packed rows whose cell is shared."""

    def fn(batches):
        for group in adjacent_groups(batches, ["part"]):
            cell, node = (np.frombuffer(b"".join(group[c].to_pylist()), dtype=np.int64) for c in ("cells", "nodes"))
            if group["part"][0].as_py() < parts:
                cell, node = _sorted_pairs(cell, node)
                again = cell[1:] == cell[:-1]
                rows = np.concatenate(([False], again)) | np.concatenate((again, [False]))
                cell, node = cell[rows], node[rows]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(node)], names=["cell", "node"])

    return fn


def _blocks(rows: DataFrame, group: str, volume: Column, most: int) -> DataFrame:
    """rows(group, node, component, ...) dealt to blocks (a, b): rows outside the group's largest component (side 0) against all (side 1).

    volume is a row's share of a block, of which neither side exceeds about ``most``. Groups of one component give nothing.
    """
    per = rows.groupBy(group, "component").agg(F.sum(volume).alias("v"), F.count("*").alias("n"))
    main = per.groupBy(group).agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max(F.struct("n", "component", "v")).alias("top"),
                                  F.sum("v").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    parts = main.select(F.col(group).alias("of"), "main", F.ceil((F.col("all") - F.col("top.v")) / most).cast("int").alias("na"),
                        F.ceil(F.col("all") / most).cast("int").alias("nb"))
    dealt = rows.join(parts, F.col(group) == F.col("of")).drop("of")
    a, b = (F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int") for seed, n in ((3, "na"), (4, "nb")))
    left = dealt.where("component != main").select("*", F.lit(0).alias("side"), a.alias("a"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"))
    right = dealt.select("*", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), b.alias("b"))
    return left.unionByName(right).drop("main", "na", "nb")


def _verify(blocks: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of blocks(group, a, b, side, node, component, signature), on their whole texts."""
    texts = likely(texts, nodes).select(F.col("doc_id").alias("text_of"), "text")
    rows = blocks.join(texts, F.col("node") == F.col("text_of")).select("group", "a", "b", "side", "node", "component", "signature", "text")
    return map_arrow(rows.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b", "side", "node"), _verified, "u long, v long")


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs(doc_id, text)."""
    every = cut_lineage(described(docs).withColumn("row", F.monotonically_increasing_id()), "ngram-sets")
    sized = every.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = cut_lineage(sized.groupBy("signature").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n")), "ngram-copies")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not sized.groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "text"])

    # cells that hold several nodes, and their hubs
    pairs = sized.agg(F.sum(F.size("cells"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // PACKED_PAIRS))
    # cells are packed where they were made: copies go under one tag, and only tags of shared cells are looked up
    tag = F.xxhash64("signature")
    packed = map_arrow(sized.select(tag.alias("node"), "cells"), _packed(parts), "part long, cells binary, nodes binary")
    held = map_arrow(packed.repartition("part").sortWithinPartitions("part"), _shared(parts), "cell long, node long")
    tags = copies.select(tag.alias("tag"), F.col("first.doc_id").alias("first_id"))
    held = held.join(tags, F.col("node") == F.col("tag")).select("tag", "cell", F.col("first_id").alias("node")).distinct()
    held = cut_lineage(held.select("cell", "node"), "ngram-held")
    meeting = cut_lineage(held.select("node").distinct(), "ngram-meeting")
    firsts = copies.select("first.*").join(meeting, F.col("doc_id") == F.col("node"), "left_semi").select(F.col("row").alias("first_row"))
    nodes = likely(sized, meeting).join(firsts, F.col("row") == F.col("first_row"), "left_semi")
    nodes = cut_lineage(nodes.select(F.col("doc_id").alias("node"), "n_shingles", "n_bytes", "signature", "point", "fine"), "ngram-nodes")
    # a cell's hub is its most central member, the one whose cells have most members
    central = held.join(held.groupBy("cell").agg(F.count("*").alias("m")), "cell").groupBy("node").agg(F.sum("m").alias("degree"))
    best = held.join(central, "node").groupBy("cell").agg(F.min_by("node", F.struct(-F.col("degree"), F.col("node"))).alias("hub"))
    members = cut_lineage(held.join(best, "cell"), "ngram-cells")

    # first links: each node with the hub that it shares most cells with
    often = members.where("node != hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
    stars = often.groupBy("node").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    vectors = nodes.select("node", "n_shingles", "point")
    ends = stars.join(nodes.select("node", "n_shingles", "point", "fine"), "node").join(nodes.select(
        F.col("node").alias("hub"), F.col("n_shingles").alias("hub_shingles"), F.col("point").alias("hub_point"), F.col("fine").alias("hub_fine")), "hub")
    stars = cut_lineage(map_arrow(ends, _likely_stars, "node long, hub long"), "ngram-stars")
    known = nodes.select("node", "n_bytes", "signature")
    star = stars.join(known, "node").select(F.col("hub").alias("group"), "node", "n_bytes", "signature")
    pieces = star.groupBy("group").agg(F.ceil(F.sum("n_bytes") / BLOCK_BYTES).cast("int").alias("pieces"))
    star = star.join(pieces, "group").select("group", F.pmod(F.xxhash64("node"), F.greatest("pieces", F.lit(1))).cast("int").alias("a"), "node", "signature", F.lit(1).alias("side"))
    hubs = pieces.join(known, F.col("group") == F.col("node")).select(
        "group", F.explode(F.sequence(F.lit(0), F.greatest("pieces", F.lit(1)) - 1)).alias("a"), "node", "signature", F.lit(0).alias("side"))
    blocks = star.unionByName(hubs).withColumn("b", F.lit(0)).withColumn("component", F.col("node"))
    first = cut_lineage(components(_verify(blocks, texts, stars.select(F.explode(F.array("node", "hub")))), "ngram-first"), "ngram-first-components")

    def placed(rows):
        return rows.join(first.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").withColumn(
            "component", F.coalesce("component", "node")).drop("linked")

    # cells of several components: which of these may similar points join?
    open_ = _blocks(cut_lineage(placed(members.select("cell", "node")), "ngram-open"), "cell", F.lit(1), BLOCK_ROWS)
    open_ = open_.join(vectors, "node").select("cell", "a", "b", "side", "node", "component", "n_shingles", "point")
    maybe = map_arrow(open_.repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b", "side", "node"), _may_join, "u long, v long")
    maybe = components(maybe, "ngram-maybe").select(F.col("node").alias("part"), F.col("component").alias("group"))

    def grouped(rows, groups, name):
        return cut_lineage(placed(rows).join(groups, F.col("component") == F.col("part")).drop("part"), name)

    # in a group of such components fine points decide again, in those that they leave the sets
    near = _blocks(grouped(nodes.select("node", "n_shingles", "point", "fine"), maybe, "ngram-near"), "group", F.length("fine") + 2 * GROUPS, BLOCK_BYTES)
    near = map_arrow(near.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b", "side", "node"), _may_join_finely, "u long, v long")
    maybe = components(near, "ngram-finely").select(F.col("node").alias("part"), F.col("component").alias("group"))
    likeliest = grouped(known, maybe, "ngram-grouped")
    last = _verify(_blocks(likeliest, "group", F.col("n_bytes"), BLOCK_BYTES), texts, likeliest.select("node"))
    ends = [first.select(F.col("node").alias(e), F.col("component").alias(f"{e}_in")) for e in ("u", "v")]
    last = last.join(ends[0], "u", "left").join(ends[1], "v", "left").select(F.coalesce("u_in", "u").alias("u"), F.coalesce("v_in", "v").alias("v"))
    final = components(last, "ngram-last").select(F.col("node").alias("part"), F.col("component").alias("whole"))

    named = placed(copies.select("signature", "n", F.col("first.doc_id").alias("node"))).join(final, F.col("component") == F.col("part"), "left")
    named = named.select("signature", "n", "node", F.coalesce("whole", "component").alias("component_id"))
    named = cut_lineage(named.where("n > 1 OR component_id != node").select("signature", "component_id"), "ngram-named")
    out = every.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("signature")).alias("signature"))
    return out.join(named, "signature", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
