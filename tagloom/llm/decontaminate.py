"""Benchmark decontamination by greedy string tiling (op5).

Texts are token sequences (runs of letters and digits, lower case; each character of a script that is
written without spaces is a token of its own). A document and a benchmark item
that share ``MIN_MATCH``-token seeds are tiled: Running Karp-Rabin finds maximal matches between
tokens not yet covered, the longest are marked first, and the search length is lowered until
``MIN_MATCH``. The covered share of the item's tokens is the score, so passages whose sentences were
reordered still count in full. Pairs of at least ``COVERAGE`` are contaminated.

The benchmark is dealt into blocks of bounded bytes; each block goes to all tasks and meets every
whole document, so documents are never shuffled and no pair table exists.

Defined results: null and empty texts match nothing, and so do items of fewer than ``MIN_MATCH``
tokens; repeated documents or items are judged row by row; an empty benchmark flags nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import map_texts

MIN_MATCH = 4
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22

_APART = np.ones(256, dtype=bool)  # bytes between tokens: all of ASCII but letters and digits
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BASE = np.uint64(0xA24BAED4963EE407)


# first bytes of characters that may be white space, punctuation or of a script without spaces; Latin letters have others
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[0xC2, *range(0xCD, 0x100)]] = True
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"


@cache
def _wide_breaks() -> str:
    """Pattern of a character that is a token of its own, or of one beyond ASCII that separates tokens."""
    apart = [c for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] in "PZ" or c in (0x85, 0x200B, 0xFEFF)]
    return f"([{_UNSPACED}])|[" + "".join(rf"\x{{{c:x}}}" for c in apart) + "]"


def tokens(values) -> textvec.Words:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.utf8_lower(values.cast(pa.large_string()))
    data, offsets = textvec.flat(values)
    if _WIDE[data].any():
        data, offsets = textvec.flat(pc.replace_substring_regex(values, _wide_breaks(), r" \1 "))
    return textvec.words(data, offsets, _APART)


@dataclass
class Block:
    """Benchmark items as token hashes, and their seeds sorted for look-up."""

    ids: list[int]
    hashes: np.ndarray
    bounds: np.ndarray
    seeds: np.ndarray
    places: np.ndarray  # first token of each seed
    items: np.ndarray  # item of each seed
    filter: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None]) -> Block:
        w = tokens(pa.array(texts, pa.string()))
        h = w.hashes()
        seeds, at = textvec.windows(h, w.bounds, MIN_MATCH)
        order = np.argsort(seeds, kind="stable")
        owner = np.searchsorted(w.bounds, at, side="right") - 1
        member = np.zeros(1 << FILTER_BITS, dtype=bool)
        member[seeds >> np.uint64(64 - FILTER_BITS)] = True
        return cls(ids, h, w.bounds, seeds[order], at[order], owner[order], member)


def _runs_free(marked: np.ndarray) -> np.ndarray:
    """For each token how many unmarked ones follow, itself included."""
    stop = np.append(np.flatnonzero(marked), len(marked))
    return stop[np.searchsorted(stop, np.arange(len(marked)))] - np.arange(len(marked))


def tile(doc: np.ndarray, item: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length) of two sequences of token hashes.

    Greedy string tiling: no token is in two tiles, longer tiles come first, then earlier ones.
    """
    tiles: list[tuple[int, int, int]] = []
    used_d, used_i = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    n = max(len(doc), len(item))
    power = np.full(n + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    pd = np.concatenate((np.zeros(1, np.uint64), np.cumsum(doc * power[: len(doc)])))
    pi = np.concatenate((np.zeros(1, np.uint64), np.cumsum(item * power[: len(item)])))

    def equal(d, i, length):  # whether two windows have one rolling hash
        return (pd[d + length] - pd[d]) * power[n - d] == (pi[i + length] - pi[i]) * power[n - i]

    size = max(least, min(len(doc), len(item)))
    while size >= least:
        free_d, free_i = _runs_free(used_d), _runs_free(used_i)
        d_at, i_at = np.flatnonzero(free_d >= size), np.flatnonzero(free_i >= size)
        matches: list[np.ndarray] = []
        if len(d_at) and len(i_at):
            hd = textvec.mix((pd[d_at + size] - pd[d_at]) * power[n - d_at])
            hi = textvec.mix((pi[i_at + size] - pi[i_at]) * power[n - i_at])
            order = np.argsort(hi, kind="stable")
            lo = np.searchsorted(hi[order], hd, side="left")
            count = np.searchsorted(hi[order], hd, side="right") - lo
            step = max(1, (1 << 20) // max(int(count.max()), 1))  # pairs are looked at in bounded lots
            for a in range(0, len(d_at), step):
                c = count[a : a + step]
                if not c.any():
                    continue
                d = np.repeat(d_at[a : a + step], c)
                k = np.repeat(lo[a : a + step] - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(c.sum())
                i = i_at[order[k]]
                before = (d > 0) & (i > 0)
                before[before] = (doc[d[before] - 1] == item[i[before] - 1]) & ~used_d[d[before] - 1] & ~used_i[i[before] - 1]
                d, i = d[~before], i[~before]  # left-maximal
                # the longest equal windows, by bisection on rolling hashes
                short, long = np.full(len(d), size), np.minimum(free_d[d], free_i[i])
                while (short < long).any():
                    mid = (short + long + 1) // 2
                    same = equal(d, i, mid)
                    short, long = np.where(same, mid, short), np.where(same, long, mid - 1)
                matches.append(np.stack([-short, d, i]))
        if matches:
            every = np.concatenate(matches, axis=1)
            heap = every[:, np.lexsort(every[::-1])].T.tolist()  # sorted, so it is a heap
            while heap:
                length, d, i = heappop(heap)
                free = ~(used_d[d : d - length] | used_i[i : i - length])
                if free.all():
                    used_d[d : d - length] = True
                    used_i[i : i - length] = True
                    tiles.append((d, i, -length))
                    continue
                # what a longer tile left of the match waits for its turn
                edge = np.flatnonzero(np.diff(np.concatenate(([False], free, [False]))))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if b - a >= size:
                        heappush(heap, [a - b, d + a, i + a])
        size = max(least, size // 2) if size > least else 0
    return tiles


def matches(values, block: Block, coverage: float = COVERAGE) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, item's tokens, covered tokens, tiles) of the texts that cover an item far enough."""
    w = tokens(values)
    h = w.hashes()
    seeds, at = textvec.windows(h, w.bounds, MIN_MATCH)
    may = block.filter[seeds >> np.uint64(64 - FILTER_BITS)]
    seeds, at = seeds[may], at[may]
    lo = np.searchsorted(block.seeds, seeds, side="left")
    count = np.searchsorted(block.seeds, seeds, side="right") - lo
    hit = count > 0
    seeds, at, lo, count = seeds[hit], at[hit], lo[hit], count[hit]
    if not len(at):
        return
    text = np.searchsorted(w.bounds, at, side="right") - 1
    cuts = np.flatnonzero(np.diff(text)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
        c = count[a:b]
        k = np.repeat(lo[a:b] - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(c.sum())
        places, items = block.places[k], block.items[k]
        firsts = np.repeat(at[a:b], c)
        for item in np.unique(items).tolist():
            mine = items == item
            start, end = block.bounds[item], block.bounds[item + 1]
            # only tokens inside seeds can be in a tile
            may = np.zeros(end - start, bool)
            for j in range(MIN_MATCH):
                may[places[mine] - start + j] = True
            if may.sum() < coverage * (end - start):
                continue
            at_doc = np.unique(np.add.outer(np.unique(firsts[mine]), np.arange(MIN_MATCH)))
            gaps = np.flatnonzero(np.diff(at_doc) > 1) + 1
            doc = np.insert(h[at_doc], gaps, np.uint64(0x5EED) + np.arange(len(gaps), dtype=np.uint64))
            tiles = tile(doc, block.hashes[start:end])
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * (end - start):
                yield int(text[a]), item, int(end - start), covered, len(tiles)


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes``; only one is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = sorted(part.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield Block.of([r[0] for r in rows], [r[1] for r in rows])


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, item_tokens, covered_tokens, n_tiles, coverage of every contaminated pair."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scan(block: Block) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
            block = shared.value
            got = list(matches(piece.column("text"), block, coverage))
            ids = piece.column("doc_id").to_pylist()
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[g[0]] for g in got], pa.int64()), pa.array([block.ids[g[1]] for g in got], pa.int64()),
                 *(pa.array([g[k] for g in got], pa.int64()) for k in (2, 3, 4)),
                 pa.array([g[3] / g[2] for g in got], pa.float64())],
                names=["doc_id", "item_id", "item_tokens", "covered_tokens", "n_tiles", "coverage"])

        return map_texts(rows, fn, "doc_id long, item_id long, item_tokens long, covered_tokens long, n_tiles long, coverage double")

    out = None
    for block in blocks(benchmark):
        found = scan(block)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs that cover no benchmark item far enough, with all their columns."""
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def fn(piece: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = np.ones(piece.num_rows, bool)
            clean[[g[0] for g in matches(piece.column("text"), shared.value, coverage)]] = False
            return piece.filter(pa.array(clean))

        docs = map_texts(docs, fn, docs.schema)
    return docs
