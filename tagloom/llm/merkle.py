"""Merkle manifest of a document table by butterfly exchange (op11).

Leaves are hashed in SQL, numbered in order by a range sort, and dealt to blocks of ``FANOUT ** BLOCK_LEVELS``
consecutive leaves, so a block is a whole subtree. Each block hashes its own nodes once. Then blocks
exchange: in round r the blocks whose numbers differ in digit r (base ``FANOUT``) alone swap the digests
of their ancestors r levels up. Every one of them hashes the run, so each ends with the next ancestor
and with its siblings for the proof; after log(blocks) rounds every block knows the root and its whole
upper proof, and nothing is passed down again. A round moves one row a block, in groups of at most
``FANOUT``; where the last subtree is short, its blocks answer for the places that it lacks.
The trees of the languages are joined into the root by the same exchange.

H is sha256 as lowercase hex over its inputs one after the other; digests go in as hex text. A field is
``-`` if null, else its UTF-8 byte count, ``:`` and its value.

Defined results: every row is a leaf, repeated rows too (equal doc_ids are ordered by leaf); a null
doc_id comes first in its language and is never tampered with; null languages are a tree of their own,
the first. Null, empty and very long texts are hashed whole. No rows: no tree, no result. Further columns
are not read. A single leaf is its tree's root; the proof of a single document is H of nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.batches import adjacent_groups, map_arrow
from tagloom.session import cut_lineage, drop_path

FANOUT = 8
BLOCK_LEVELS = 4  # a block holds 4,096 leaves
TAMPER_EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(col: Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else byte count, colon, value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    return F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(F.col("n_chars")), field(text)), 256)


def tampered() -> Column:
    """Whether a document's text is lower-cased (A-Z only) before it is checked."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed, row) of every row: its leaf, the leaf of its tampered text (null if none), a row number."""
    changed = F.when(tampered() & F.col("text").isNotNull(), leaf(F.translate(F.col("text"), UPPER, LOWER)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("lang").cast("string").alias("lang"), "n_chars",
                       F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), changed.alias("changed"),
                       F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """rows sorted by group and order (nulls first), with ``part`` and ``at``, and (group, part, first, before, total) to number them.

    A row's number in its group is ``before + at - first``. The sort is by ranges, so a large group is
    spread over tasks; the second table has a row for each group and task that meet.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = cut_lineage(placed, name)
    counts = placed.groupBy(*group, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                            F.sum("n").over(whole).alias("total"))
    return placed, cut_lineage(offsets, f"{name}-offsets")


def depth(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // FANOUT), out + 1
    return out


def levels_of(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes, and those of every level above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest(*out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def butterfly(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, node, digest, proof) for nodes(tree, node, digest): each tree's root, and each node's siblings, level by level.

    A tree's nodes are numbered from 0 without gaps. proof is an array of (place, others): the
    node's place in its run and the digests of the run's other members, left to right.
    """
    spark = nodes.sparkSession
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n"))
    state = cut_lineage(nodes.join(sizes, "tree").select("tree", "node", "n", "digest", F.expr("array()").cast(
        "array<struct<place:int,others:array<string>>>").alias("proof")), name)
    most = state.agg(F.max("n")).first()[0] or 0
    span = 1  # nodes under one ancestor
    while span < most:
        run, low = F.floor(F.col("node") / (span * FANOUT)), F.col("node") % span
        place = F.floor(F.col("node") / span) % FANOUT
        keyed = state.select("*", run.alias("run"), low.alias("low"), place.cast("int").alias("place"))
        running = keyed.where(F.col("n") > span)  # trees that have their root are done
        mine = F.least(F.lit(span), F.col("n") - (F.col("node") - F.col("low")))  # nodes that my ancestor has
        asked = F.when(F.col("place") == 0, mine).otherwise(F.lit(span))  # the places that I answer for
        answers = running.select("tree", "run", "place", "digest", F.explode(F.sequence(F.col("low"), asked - 1, mine)).alias("low"))
        swapped = answers.groupBy("tree", "run", "low").agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("members"))
        met = running.drop("digest").join(swapped, ["tree", "run", "low"])
        others = F.transform(F.filter("members", lambda m: m["place"] != F.col("place")), lambda m: m["digest"])
        joined = met.select("tree", "node", "n", F.sha2(F.concat_ws("", "members.digest"), 256).alias("digest"),
                            F.concat("proof", F.array(F.struct("place", others.alias("others")))).alias("proof"))
        new = cut_lineage(joined.unionByName(state.where(F.col("n") <= span)), name)
        drop_path(spark, state._tagloom_path)
        state, span = new, span * FANOUT
    return state.drop("n")


def _block_roots(block_levels: int):
    def fn(batches):
        for group in adjacent_groups(batches, ["tree", "block"]):
            levels = min(block_levels, depth(group["total"][0].as_py()))
            top = levels_of(group["leaf"].to_pylist(), levels)[-1]
            yield pa.RecordBatch.from_arrays([*(group[c].combine_chunks().slice(0, 1) for c in ("tree", "block")), pa.array(top)],
                                             names=["tree", "node", "digest"])
    return fn


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _fold(batches, block_levels: int):
    """Result rows of each block: its first row holds what the exchange brought, the others its leaves in order."""
    for group in adjacent_groups(batches, ["tree", "block"]):
        upper = [("".join(p["others"][: p["place"]]), "".join(p["others"][p["place"] :])) for p in group["proof"][0].as_py()]
        subroot, root = group["subroot"][0].as_py(), group["root"][0].as_py()
        group = group.slice(1)
        nodes, changed = group["leaf"].to_pylist(), group["changed"].to_pylist()
        levels = min(block_levels, depth(group["total"][0].as_py()))
        runs = [["".join(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)] for level in levels_of(nodes, levels)[:-1]]
        above = "".join(a + b for a, b in upper)
        proofs, folded = [], []
        for i, node in enumerate(nodes):
            now, proof = changed[i] or node, hashlib.sha256()
            for run in runs:
                i, place = divmod(i, FANOUT)
                left, right = run[i][: 64 * place], run[i][64 * place + 64 :]
                proof.update((left + right).encode())
                now = digest(left, now, right)
            for left, right in upper:
                now = digest(left, now, right)
            proof.update(above.encode())
            proofs.append(proof.hexdigest())
            folded.append(now)
        yield pa.RecordBatch.from_arrays(
            [group["doc_id"].combine_chunks(), pa.array(nodes), *(pa.repeat(pa.scalar(x), len(nodes)) for x in (subroot, root)),
             pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded])],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def manifest(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs."""
    hashed = cut_lineage(leaves(docs), "merkle-leaves")  # the last key tells equal rows apart, so they too can be dealt to several tasks
    placed, offsets = numbered(hashed, ["lang"], ["doc_id", "leaf", "row"], "merkle-order")
    named, counted = numbered(offsets.select("lang").distinct(), [], ["lang"], "merkle-trees")
    trees = named.join(counted, "part").select(F.col("lang").alias("tree_lang"), (F.col("before") + F.col("at") - F.col("first")).alias("tree"))
    offsets = offsets.join(trees, F.col("lang").eqNullSafe(F.col("tree_lang"))).select(
        "tree", "total", F.col("lang").alias("of"), F.col("part").alias("in_part"), (F.col("before") - F.col("first")).alias("shift"))
    size = FANOUT**block_levels
    ordered = placed.join(offsets, F.col("lang").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part"))).select(
        "tree", "total", (F.col("at") + F.col("shift")).alias("nth"), "doc_id", "leaf", "changed").withColumn("block", F.floor(F.col("nth") / size))
    blocks = ordered.select("tree", "block", "nth", "total", "leaf").repartition("tree", "block").sortWithinPartitions("tree", "block", "nth")
    tops = butterfly(map_arrow(blocks, _block_roots(block_levels), "tree long, node long, digest string"), "merkle-blocks")
    subroots = tops.where("node = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("node"), "digest")
    crown = butterfly(subroots, "merkle-crown").select(F.col("node").alias("tree"), F.col("digest").alias("root"), F.col("proof").alias("crown"))
    known = tops.join(crown, "tree").select("tree", F.col("node").alias("block"), F.lit(-1).cast("long").alias("nth"),
                                            F.concat("proof", "crown").alias("proof"), F.col("digest").alias("subroot"), "root")
    rows = ordered.unionByName(known, allowMissingColumns=True).repartition("tree", "block").sortWithinPartitions("tree", "block", "nth")
    return map_arrow(rows, lambda batches: _fold(batches, block_levels), _RESULT)
