"""Near-duplicate detection with SetSketch registers (op6).

Every document's set of word shingles is summed up by ``registers`` truncated, exponentially spaced
minima (SetSketch, base ``BASE``): a register is ``floor(1 - log_b x)`` for the least of the set's
exponential draws ``x``. Registers of a union are the element-wise maxima, so sketches merge; equal
registers grow likelier with Jaccard similarity, so bands of them are a locality-sensitive key.

1. one pass over the texts writes size, set signature and registers of each document;
2. documents with equal sets share a representative (the least id), so copies never meet in pairs;
3. representatives with an equal band link to a least id of the band, first within each batch of rows,
   then the batches' least ids (all that is moved by band) to the least of all: coarse groups are the
   components of those links, so each pair that shares a band is inside one group;
4. groups are cut into blocks of bounded bytes; in a block, the joint likelihood of the registers
   rules pairs out, the rest is confirmed on the full sets, and a block returns a spanning forest of
   its links, never all its pairs;
5. components of the forest, brought back to all copies.

Defined results: null or wordless texts have an empty set and link with nothing. Repeated rows are
copies of each other and get equal results; a null doc_id links with nothing (component_id null,
kept true). Rows of one doc_id with different texts are each grouped by their own text; if that id
stands for both texts' copies, it also joins their groups. One row comes out for each row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tagloom.llm import textvec
from tagloom.llm.batches import adjacent_groups, map_arrow, map_texts
from tagloom.llm.components import components
from tagloom.session import cut_lineage

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
ROWS, BANDS = 4, 36  # a pair at the threshold misses all bands with probability (1 - .75^4)^36 = 1e-6
REGISTERS = ROWS * BANDS
#: A pair is ruled out unseen if its likeliest similarity is below this: seven standard errors under the threshold.
RULED_OUT = 0.5
BLOCK_BYTES = 8 << 20
ID_SLOTS = 1 << 20  # most numbers that are broadcast to tell which documents may be wanted

_rng = np.random.default_rng(97)
_XOR = _rng.integers(0, 2**63, REGISTERS, dtype=np.int64).view(np.uint64)
_MUL = _rng.integers(1, 2**63, REGISTERS, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers (one row for each set) of sets of 64-bit hashes; an empty set has zeros."""
    out = np.zeros((len(bounds) - 1, REGISTERS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    at = bounds[:-1][full]
    for j in range(REGISTERS):
        u = np.minimum.reduceat((sets ^ _XOR[j]) * _MUL[j], at).astype(np.float64)
        x = -np.log1p(-(u + 0.5) / 2.0**64) / RATE  # least of the set's exponential draws
        out[full, j] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _log_odds_slope(j, n_a, n_b, greater, less, same):
    """Slope of the joint log-likelihood of the registers at similarity j (concave in j)."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    lb = np.log(BASE)

    def p(x):  # probability that one register exceeds the other by the given share of draws
        return -np.log1p(-x * (BASE - 1) / BASE) / lb

    def dp(x):
        return (BASE - 1) / BASE / (1 - x * (BASE - 1) / BASE) / lb

    xa, xb = np.maximum(u - v * j, 1e-9), np.maximum(v - u * j, 1e-9)
    pa_, pb = p(xa), p(xb)
    rest = np.maximum(1 - pa_ - pb, 1e-9)
    da, db = -v * dp(xa), -u * dp(xb)
    return greater * da / pa_ + less * db / pb - same * (da + db) / rest


def similar_enough(n_a, n_b, a: np.ndarray, b: np.ndarray, j: float = RULED_OUT) -> np.ndarray:
    """Whether the likeliest similarity of set a to each set b is at least j, by their registers jointly."""
    greater, less = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
    top = np.minimum(n_a / n_b, n_b / n_a)  # no pair of these sizes is more similar
    slope = _log_odds_slope(np.minimum(j, top), n_a, n_b, greater, less, REGISTERS - greater - less)
    return (top >= j) & (slope >= 0)


def similarity(n_a: float, n_b: float, a: np.ndarray, b: np.ndarray) -> float:
    """The likeliest Jaccard similarity of two sets, from sizes and registers."""
    lo, hi = 0.0, min(n_a / n_b, n_b / n_a)
    greater, less = int((a > b).sum()), int((a < b).sum())
    for _ in range(40):
        mid = (lo + hi) / 2
        if _log_odds_slope(mid, n_a, n_b, greater, less, REGISTERS - greater - less) >= 0:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def shingles_of(values) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = textvec.flat(values)
    return textvec.shingle_sets(textvec.words(textvec.LOWER[data], offsets), SHINGLE_WORDS)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128-bit digest of each whole set; none for an empty one."""
    raw = sets.view(np.uint8)
    return [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, n_bytes, signature, registers) of every row of docs."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        values = piece.column("text")
        sets, bounds = shingles_of(values)
        regs = sketch(sets, bounds)
        sig = signatures(sets, bounds)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.diff(bounds)), pa.array(np.diff(textvec.flat(values)[1])),
             pa.array(sig, pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())],
            names=["doc_id", "n_shingles", "n_bytes", "signature", "registers"])

    return map_texts(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                     "doc_id long, n_shingles long, n_bytes long, signature binary, registers binary")


def _hashed(doc_id):
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit(9)), F.lit(ID_SLOTS))


def likely(docs: DataFrame, ids: DataFrame, negate: bool = False) -> DataFrame:
    """Rows of docs whose doc_id may be among ids (negate: certainly is not), without moving them.

    The ids' hashes to ``ID_SLOTS`` slots are broadcast, so at most that many numbers, however many
    ids there are; rows that share a slot by chance are left to the exact join that follows.
    """
    slots = ids.select(_hashed(F.col(ids.columns[0])).alias("slot")).distinct()
    return docs.join(F.broadcast(slots), _hashed(docs["doc_id"]) == slots["slot"], "left_anti" if negate else "left_semi")


def _batch_stars(batches):
    """Rows (key, u, v) of each batch: every band's least member (its key is the band, v null), and the links to it.

    A link's key is its member, so links are dealt evenly; each is there once however many bands make it.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        band, u = batch.column("bands").flatten().to_numpy(), np.repeat(batch.column("u").to_numpy(), BANDS)
        order = np.lexsort((u, band))
        band, u = band[order], u[order]
        first = np.concatenate(([True], band[1:] != band[:-1]))
        leader = u[first][np.cumsum(first) - 1]
        links = np.unique(np.stack([u, leader])[:, u != leader], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([band[first], links[0]])), pa.array(np.concatenate([u[first], links[0]])),
             pa.concat_arrays([pa.nulls(int(first.sum()), pa.int64()), pa.array(links[1])])], names=["key", "u", "v"])


def _band_stars(batches):
    """Links (u, v): those there are, and from every leader of a band to its least one; rows come sorted by v's being there, key, u."""
    band, least = None, None
    for batch in batches:
        done = batch.column("v").is_valid()
        if batch.num_rows and pc.any(done).as_py():
            made = batch.filter(done)
            yield pa.RecordBatch.from_arrays([made.column("u"), made.column("v")], names=["u", "v"])
            batch = batch.filter(pc.invert(done))
        b, u = batch.column("key").to_numpy(), batch.column("u").to_numpy()
        if not len(b):
            continue
        first = np.concatenate(([band is None or b[0] != band], b[1:] != b[:-1]))
        run = np.cumsum(first)
        leaders = np.concatenate(([least if least is not None else u[0]], u[first]))
        v = leaders[run]
        band, least = b[-1], v[-1]
        linked = u != v
        if linked.any():
            yield pa.RecordBatch.from_arrays([pa.array(u[linked]), pa.array(v[linked])], names=["u", "v"])


class Forest:
    """Union-find over 0..n-1 whose roots are least members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def linked(sets: np.ndarray, bounds: np.ndarray, regs: np.ndarray, percent: int = SIMILARITY_PERCENT) -> np.ndarray:
    """Root of each set in the forest of links of 100 * intersection >= percent * union.

    For each set in turn, the registers choose partners that may be similar and are not yet in its tree;
    only if there are any, its intersections with all sets are counted through the sets' shared shingles.
    """
    n = len(bounds) - 1
    size = np.diff(bounds)
    forest = Forest(n)
    roots = np.arange(n)
    _, ids = np.unique(sets, return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(ids, kind="stable")
    holders = owner[order]  # sets that hold a shingle, by shingle
    first = np.searchsorted(ids[order], np.arange(ids.max() + 2 if len(ids) else 1))
    for x in range(n - 1):
        y = np.arange(x + 1, n)
        y = y[(roots[y] != roots[x]) & (size[y] > 0)] if size[x] else y[:0]
        if len(y):
            y = y[similar_enough(size[x], size[y], regs[x], regs[y])]
        if not len(y):
            continue
        mine = ids[bounds[x] : bounds[x + 1]]
        counts = first[mine + 1] - first[mine]
        at = np.repeat(first[mine] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        both = np.bincount(holders[at], minlength=n)[y]
        hits = y[100 * both >= percent * (size[x] + size[y] - both)]
        if len(hits):
            for h in hits.tolist():
                forest.link(x, h)
            roots = np.array([forest.root(i) for i in range(n)])
    return roots


def _block_links(batches):
    for group in adjacent_groups(batches, ["group", "a", "b"]):
        ids = group["doc_id"].to_numpy()
        sets, bounds = shingles_of(group["text"])
        own = np.array([a == b for a, b in zip(signatures(sets, bounds), group["signature"].to_pylist())])
        if not own.all():  # another text under the same id
            group = group.filter(pa.array(own))
            ids = group["doc_id"].to_numpy()
            sets, bounds = shingles_of(group["text"])
        regs = np.frombuffer(b"".join(group["registers"].to_pylist()), dtype=np.uint16).reshape(len(ids), REGISTERS)
        order = np.argsort(ids, kind="stable")
        if len(order) > 1 and (order != np.arange(len(order))).any():
            size = np.diff(bounds)
            sets = np.concatenate([sets[bounds[i] : bounds[i + 1]] for i in order])
            bounds = np.concatenate(([0], np.cumsum(size[order])))
            ids, regs = ids[order], regs[order]
        roots = linked(sets, bounds, regs)
        got = np.flatnonzero(roots != np.arange(len(roots)))
        if len(got):
            yield pa.RecordBatch.from_arrays([pa.array(ids[got]), pa.array(ids[roots[got]])], names=["u", "v"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text)."""
    return verdicts(docs).drop("signature")


def verdicts(docs: DataFrame) -> DataFrame:
    """near_duplicates with the signature of each row's set (null if it has none or no doc_id)."""
    sk = cut_lineage(sketches(docs), "sketches")
    sized = sk.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = cut_lineage(sized.groupBy("signature").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "copies")
    # one row for each distinct set: its least id (a repeated row gives the same values)
    reps = sized.join(copies.select(F.col("signature").alias("sig"), "rep"),
                      (F.col("signature") == F.col("sig")) & (F.col("doc_id") == F.col("rep")), "left_semi")
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)])
    leaders = map_arrow(reps.select(keys.alias("bands"), F.col("doc_id").alias("u")), _batch_stars, "key long, u long, v long")
    stars = map_arrow(leaders.repartition("key").sortWithinPartitions(F.isnotnull("v"), "key", "u"), _band_stars, "u long, v long").distinct()
    coarse = cut_lineage(components(stars, "coarse"), "coarse")

    members = reps.join(coarse, F.col("doc_id") == F.col("node")).select(
        F.col("component").alias("group"), "doc_id", "n_bytes", "registers", "signature")
    members = cut_lineage(members.dropDuplicates(["doc_id", "signature"]), "members")
    volume = members.groupBy("group").agg(F.sum(F.col("n_bytes") + 2 * REGISTERS).alias("bytes"))
    # a group over the block size is dealt into chunks of half a block, and each pair of chunks is a block
    parts = F.when(F.col("bytes") <= BLOCK_BYTES, 1).otherwise(F.ceil(2 * F.col("bytes") / BLOCK_BYTES)).cast("int")
    chunked = members.join(volume.select("group", parts.alias("parts")), "group").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("parts")).cast("int"))
    other = F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda c: c != F.col("chunk"))))
    blocks = chunked.select("group", "doc_id", "registers", "signature", "chunk", other.alias("other")).select(
        "group", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
        "doc_id", "registers", "signature")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with_text = blocks.join(likely(texts, members.select("doc_id")), "doc_id").select("group", "a", "b", "doc_id", "registers", "signature", "text")
    links = map_arrow(with_text.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b"),
                      _block_links, "u long, v long")
    groups = components(links, "links")
    # every set's component, where it isn't simply the document itself
    named = copies.join(groups, F.col("rep") == F.col("node"), "left").select(
        "signature", "n", F.col("rep"), F.coalesce("component", "rep").alias("component_id"))
    named = cut_lineage(named.where("n > 1 OR component_id != rep").select("signature", "component_id"), "named")
    out = sk.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("signature")).alias("signature"))
    out = out.join(named, "signature", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "signature")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def signed(docs: DataFrame, name: str) -> DataFrame:
    """docs with the signature of each row's set as a further column."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        sig = pa.array(signatures(*shingles_of(piece.column("text"))), pa.binary())
        return pa.RecordBatch.from_arrays([*piece.columns, sig], names=[*piece.schema.names, name])

    return map_texts(docs, fn, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs whose document is its group's least id; of rows with equal id and text one stays."""
    verdict = cut_lineage(verdicts(docs).where("doc_id IS NOT NULL").select("doc_id", "signature", "kept"), "verdict")
    judged = verdict.groupBy("doc_id").agg(F.count_if("kept").alias("stay"), F.count_if(~F.col("kept")).alias("go"))
    judged = cut_lineage(judged.where("go > 0 OR stay > 1"), "judged")
    gone = judged.where("stay = 0").select(F.col("doc_id").alias("gone"))
    mixed = judged.where("stay > 0 AND go > 0").select(F.col("doc_id").alias("mixed"))
    repeated = judged.where("stay > 1").select(F.col("doc_id").alias("repeated"))
    # only rows that may have to go are moved
    may_go = likely(docs, gone)
    kept = likely(docs, gone, negate=True).unionByName(may_go.join(gone, may_go["doc_id"] == gone["gone"], "left_anti"))
    if not mixed.isEmpty():  # ids with several texts of which some go: by id and text
        name = "set_signature"
        while name.lower() in map(str.lower, docs.columns):
            name += "_"
        texts = verdict.where("NOT kept").join(mixed, F.col("doc_id") == F.col("mixed"), "left_semi").select(
            F.col("doc_id").alias("gone"), F.col("signature").alias("gone_signature")).distinct()
        own = signed(likely(kept, mixed), name)
        own = own.join(texts, (own["doc_id"] == texts["gone"]) & (own[name] == texts["gone_signature"]), "left_anti").drop(name)
        kept = likely(kept, mixed, negate=True).unionByName(own)
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, kept["doc_id"] == repeated["repeated"], "left_semi")
    once = kept.join(repeated, kept["doc_id"] == repeated["repeated"], "left_anti")
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))
