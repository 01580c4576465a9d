"""Best-fit packing of tokenised documents into fixed-length sequences (op10).

A document is its token ids and an end id; longer ones are cut into pieces of ``MAX_TOKENS``, the
first of which may be shorter. Packing looks at the histogram of piece lengths alone, which has at
most ``MAX_TOKENS`` bins whatever the corpus: patterns of two to four lengths that fill a sequence are
enumerated, non-negative least squares fits how often each is used, the counts are rounded within
what the histogram holds, and best-fit decreasing packs the residual (also by whole groups of equal
lengths). The plan is a small table of runs (length, first rank, ...): every piece finds its sequence
and offset from its rank among the pieces of its length, which is counted per task and joined up by
task, so no task holds all pieces of a length.

Defined results: a null or empty text is its end id alone; repeated rows and null ids are packed row
by row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.batches import map_arrow, strings, text_slices
from tagloom.llm.tokenizers_io import byte_bpe, tokenizer_path
from tagloom.session import cut_lineage

MAX_TOKENS = 2048
END_ID = 0
PATTERNS_PER_LENGTH = 12


def cut(n: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than ``most``."""
    first = n % most or most
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def token_pieces(docs: DataFrame, tokenizer: str, most: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the task and the rank in it among pieces of the length."""

    def run(batches):
        encoder, task = byte_bpe(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(most + 1, dtype=np.int64)
        for batch in batches:
            for part in text_slices(batch):
                out: list[list] = [[] for _ in range(7)]
                for doc_id, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text"))):
                    ids = np.append(encoder.encode(text), END_ID).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), most)):
                        raw = ids[start : start + length].tobytes()
                        row = (doc_id, k, start, length, zlib.crc32(raw), seen[length], raw if with_ids else None)
                        seen[length] += 1
                        for column, value in zip(out, row):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(out, kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank", "ids"]
                arrays.append(pa.array(np.full(len(out[0]), task, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays(arrays[: None if with_ids else 6] + ([] if with_ids else arrays[7:]),
                                                 names=names[: 7 if with_ids else 6] + ["task"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long, rank long"
                     + (", ids binary" if with_ids else "") + ", task int")


def patterns(lengths: np.ndarray, most: int, per_length: int = PATTERNS_PER_LENGTH) -> list[tuple[int, ...]]:
    """Patterns of two to four of the lengths that fill a sequence exactly, some for each length."""
    have = np.zeros(most + 1, dtype=bool)
    have[lengths] = True
    found: set[tuple[int, ...]] = set()
    for a in lengths.tolist():
        room = most - a
        if room > 0 and have[room]:
            found.add(tuple(sorted((a, room))))
        seconds = lengths[lengths < room]
        if not len(seconds):
            continue
        thirds = seconds[have[room - seconds]]
        for b in thirds[np.linspace(0, len(thirds) - 1, min(per_length, len(thirds))).astype(int)].tolist():
            found.add(tuple(sorted((a, b, room - b))))
        for b in seconds[np.linspace(0, len(seconds) - 1, min(4, len(seconds))).astype(int)].tolist():
            left = room - b
            last = lengths[lengths < left]
            last = last[have[left - last]]
            for c in last[np.linspace(0, len(last) - 1, min(per_length // 4, len(last))).astype(int)].tolist():
                found.add(tuple(sorted((a, b, c, left - c))))
    return sorted(found)


def nonnegative_fit(found: list[tuple[int, ...]], histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns with least squared distance of what they use to the histogram.

    Accelerated projected gradient; a pattern touches at most four bins, so a step is linear in patterns.
    """
    width = max(map(len, found))
    at = np.full((len(found), width), len(histogram))  # the last bin is a dummy
    for i, p in enumerate(found):
        at[i, : len(p)] = p
    target = np.append(histogram, 0).astype(float)
    x = np.zeros(len(found))
    y, t = x.copy(), 1.0
    # the largest eigenvalue of A'A is at most the largest row sum of A times the width
    touch = np.bincount(at.ravel(), minlength=len(target))[:-1].max()
    rate = 1.0 / (width * max(touch, 1))
    for _ in range(steps):
        rest = np.bincount(at.ravel(), weights=np.repeat(y, width), minlength=len(target)) - target
        rest[-1] = 0
        new = np.maximum(y - rate * rest[at].sum(axis=1), 0)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / grown * (new - x), new, grown
    return x


def rounded(fitted: np.ndarray, found: list[tuple[int, ...]], left: np.ndarray) -> list[tuple[int, int]]:
    """(pattern, repeat) in whole numbers, as far as there are pieces; takes these from ``left``.

    The longest pieces are dealt first, since little goes with them: among the patterns whose longest piece is of one length,
    whole parts of the fitted counts, then once more by largest remainder, over and over while such pieces are left.
    """
    placed = np.zeros(len(found), dtype=np.int64)
    longest: dict[int, list[int]] = {}
    for i in np.argsort(-fitted, kind="stable").tolist():
        longest.setdefault(found[i][-1], []).append(i)

    def put(i: int, repeat: int) -> bool:
        repeat = min([repeat, *(int(left[n]) // found[i].count(n) for n in set(found[i]))])
        placed[i] += repeat
        for n in found[i]:
            left[n] -= repeat
        return repeat > 0

    for n in sorted(longest, reverse=True):
        own = longest[n]
        for i in own:
            put(i, int(fitted[i] + 1e-9))
        own = sorted(own, key=lambda i: (np.floor(fitted[i] + 1e-9) - fitted[i], i))
        while left[n] and own:
            own = [i for i in own if left[n] and put(i, 1)]
    return [(i, int(placed[i])) for i in np.flatnonzero(placed).tolist()]


def by_patterns(left: np.ndarray, most: int = MAX_TOKENS) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Sequences of patterns fitted to the pieces of a histogram, which are taken from ``left``."""
    lengths = np.flatnonzero(left)
    found = patterns(lengths, most) if len(lengths) else []
    used = rounded(nonnegative_fit(found, left), found, left) if found else []
    return [(tuple((n, found[i].count(n)) for n in sorted(set(found[i]), reverse=True)), repeat) for i, repeat in used]


def best_fit(left: np.ndarray, most: int = MAX_TOKENS) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, decreasing, in groups of sequences with equal content."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    for n in np.flatnonzero(left)[::-1].tolist():
        c = int(left[n])
        while c:
            room = min((s for s in open_ if s >= n), default=None)
            runs, count = open_[room].pop() if room is not None else ((), c)
            if room is None:
                room = most
            elif not open_[room]:
                del open_[room]
            copies = min(room // n, c)  # what best fit puts into each before the next
            used = min(count, c // copies)
            if used < count and runs:
                open_.setdefault(room, []).append((runs, count - used))
            c -= copies * used
            open_.setdefault(room - copies * n, []).append((runs + ((n, copies),), used))
    return [g for groups in open_.values() for g in groups]


def plan(histogram: np.ndarray, most: int = MAX_TOKENS) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns as runs ((length, copies), ...) with how many sequences use each; uses every piece once.

    Patterns are fitted round after round on the pieces that the last round left, until none fits; the residual of the round
    after which best fit needs the fewest sequences in all goes to best fit.
    """
    left = histogram.astype(np.int64).copy()
    done: list[tuple[tuple[tuple[int, int], ...], int]] = []
    if left[most]:
        done.append((((most, 1),), int(left[most])))
        left[most] = 0
    fewest, best = None, done
    while True:
        new = by_patterns(left, most)
        done = done + new
        if new or fewest is None:
            whole = done + best_fit(left, most)
            if fewest is None or sum(c for _, c in whole) <= fewest:
                fewest, best = sum(c for _, c in whole), whole
        if not new:
            return best


def runs_table(packed: list[tuple[tuple[tuple[int, int], ...], int]], most: int = MAX_TOKENS) -> dict[str, np.ndarray]:
    """Where pieces go: by length and first rank, the copies in a sequence, first sequence and offset."""
    used = np.zeros(most + 1, dtype=np.int64)
    rows, sequence = [], 0
    for runs, count in packed:
        offset = 0
        for n, copies in runs:
            rows.append((n, int(used[n]), copies, sequence, offset))
            used[n] += copies * count
            offset += n * copies
        sequence += count
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {"length": columns[0], "first": columns[1], "copies": columns[2], "sequence": columns[3], "offset": columns[4]}


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, from length and rank among the pieces of that length."""
    key = (table["length"] << 48) + table["first"]
    at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
    nth, copies = rank - table["first"][at], table["copies"][at]
    return table["sequence"][at] + nth // copies, table["offset"][at] + nth % copies * length


def pack(docs: DataFrame, tokenizer: str | None = None, most: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece of docs."""
    pieces = cut_lineage(token_pieces(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"), most, with_ids), "pieces")
    per_task = cut_lineage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(most + 1, dtype=np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``most`` rows
        histogram[row["length"]] = row["n"]
    table = runs_table(plan(histogram, most), most)
    # a piece's rank in all: what earlier tasks have of its length, and its rank in its own task
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"])

    def fn(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = place(table, length, rank)
            keep = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(keep + [pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return map_arrow(
        ranked.select(*names, (F.col("rank") + F.col("before")).alias("rank")), fn, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
        + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its token ids (little-endian 32-bit), from pack(..., with_ids=True)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most MAX_TOKENS ids in a sequence
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
