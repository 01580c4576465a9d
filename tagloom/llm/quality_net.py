"""Quality classifier (op7): random-indexing word vectors, pooled per document, under a two-layer network.

Random indexing: every vocabulary entry has a fixed sparse ternary index vector; the context vector of
an entry is the sum of the index vectors of its neighbours within ``REACH`` words, over the whole
corpus. The vocabulary is hashed into ``ENTRIES`` entries, so the vectors have a fixed size however
large the corpus is: tasks add up counts of (entry, dimension), Spark sums them by entry, and the
driver gets ``ENTRIES`` x ``DIMS`` numbers. Words are runs of letters and digits or runs of other
signs, case kept; words all in capitals and words all of digits are one entry each.

A document is the mean, and the spread, of its words' context and index vectors. The network is
trained in numpy on a bounded sample of labelled rows (``TRAIN_ROWS``, never of fold 0), and its
logits are divided by a temperature fitted on a fold that it never saw.

Defined results: null and empty texts pool to zeros and get the network's score of that; repeated
rows and null ids are scored row by row (a null id is not held out). Without usable labels of both
kinds the score is the share of good labels, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import map_arrow, map_texts, text_slices
from tagloom.llm.samples import fold, labelled_texts

ENTRIES = 1 << 13
DIMS = 32
NONZERO = 4
REACH = 2
HIDDEN = 32
TRAIN_ROWS = 8000
PREDICT_FROM = 0.3
CAPITALS, DIGITS = 0, 1  # entries of their own

_rng = np.random.default_rng(411)
INDEX = np.zeros((ENTRIES, DIMS), dtype=np.float32)  # index vectors
_AT = np.argsort(_rng.random((ENTRIES, DIMS)), axis=1)[:, :NONZERO]
_SIGN = _rng.choice([-1.0, 1.0], (ENTRIES, NONZERO)).astype(np.float32)
np.put_along_axis(INDEX, _AT, _SIGN, axis=1)

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 white space, 1 sign, 2 letter or digit (and all bytes over ASCII)
_CLASS[:] = 1
_CLASS[textvec.IS_SPACE] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 2
_LETTER_LOW = np.zeros(256, dtype=bool)
_LETTER_LOW[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True


def entries(values) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary entry of every word of texts, and bounds of each text's words."""
    data, offsets = textvec.flat(values)
    kind = _CLASS[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    solid = kind[starts] > 0 if len(data) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    w = textvec.Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))
    entry = 2 + (w.hashes() >> np.uint64(32)).astype(np.int64) % (ENTRIES - 2)
    low = np.concatenate(([0], np.cumsum(_LETTER_LOW[data])))
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    letters = kind[starts] == 2 if len(starts) else np.zeros(0, bool)
    all_digits = (digits[ends] - digits[starts]) == (ends - starts)
    capitals = letters & ~all_digits & (low[ends] == low[starts]) & (ends - starts > 1)
    entry[capitals] = CAPITALS
    entry[all_digits] = DIGITS
    return entry, w.bounds


def _context_task(batches):
    """Sums of the neighbours' index vectors, and word counts, of each entry over one task's texts."""
    total = np.zeros((ENTRIES, DIMS), dtype=np.int64)
    count = np.zeros(ENTRIES, dtype=np.int64)
    for batch in batches:
        for piece in text_slices(batch, limit=4 * textvec.SLICE_BYTES):
            entry, bounds = entries(piece.column("text"))
            count += np.bincount(entry, minlength=ENTRIES)
            text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            # how often each neighbour stands by each entry, then its index vector so many times
            near = np.zeros((ENTRIES, DIMS))
            for step in range(1, REACH + 1):
                same = text_of[step:] == text_of[:-step]
                a, b = entry[:-step][same], entry[step:][same]
                for mine, other in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        near += np.bincount(mine * DIMS + _AT[other, k], weights=_SIGN[other, k],
                                            minlength=ENTRIES * DIMS).reshape(ENTRIES, DIMS)
            total += near.astype(np.int64)
    seen = np.flatnonzero(count)
    for a in range(0, len(seen), 1024):
        part = seen[a : a + 1024]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(count[part]), *(pa.array(total[part, d]) for d in range(DIMS))],
            names=["entry", "n", *(f"d{d}" for d in range(DIMS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all entries (ENTRIES x DIMS) from every text of docs."""
    dims = [f"d{d}" for d in range(DIMS)]
    parts = map_arrow(
        docs.select(F.col("text").cast("string").alias("text")), _context_task, "entry long, n long, " + ", ".join(f"{d} long" for d in dims))
    sums = parts.groupBy("entry").agg(F.sum("n").alias("n"), *(F.sum(d).alias(d) for d in dims))
    out = np.zeros((ENTRIES, DIMS), dtype=np.float32)
    for row in sums.toLocalIterator():  # at most ENTRIES rows
        v = np.array(row[2:], dtype=np.float64)
        norm = np.sqrt((v * v).sum())
        if norm:
            out[row[0]] = v / norm
    return out


def pooled(values, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the context and index vectors of each text's words, and its log length."""
    entry, bounds = entries(values)
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    out = np.zeros((len(n), 4 * DIMS + 1), dtype=np.float32)
    if len(full):
        for k, table in enumerate((vectors, INDEX)):
            v = table[entry]
            at = bounds[:-1][full]
            mean = np.add.reduceat(v, at, axis=0) / n[full, None]
            square = np.add.reduceat(v * v, at, axis=0) / n[full, None]
            out[full, 2 * k * DIMS : (2 * k + 1) * DIMS] = mean
            out[full, (2 * k + 1) * DIMS : (2 * k + 2) * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[full, -1] = np.log1p(n[full])
    return out


@dataclass
class Net:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, epochs: int = 80, rate: float = 3e-3, decay: float = 1e-3) -> Net:
    """Two layers by Adam on the rows not held; temperature on the held ones."""
    rng = np.random.default_rng(5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    net = Net(mean, scale, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    par = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    rows, t = np.flatnonzero(~held), 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for a in range(0, len(rows), 128):
            at = rows[a : a + 128]
            h = np.tanh(z[at] @ par[0] + par[1])
            r = (1 / (1 + np.exp(-np.clip(h @ par[2] + par[3], -30, 30))) - y[at]) / len(at)
            dh = np.outer(r, par[2]) * (1 - h * h)
            grads = [z[at].T @ dh + decay * par[0], dh.sum(axis=0), h.T @ r + decay * par[2], np.array([r.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                par[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = par[0], par[1], par[2], float(par[3][0])
    if held.any():
        logits, target = net.logits(x[held]), y[held]
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, -(2 * target - 1) * logits / c).mean() for c in choices]
        net.temperature = float(choices[int(np.argmin(loss))])
    return net


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_rows: int = TRAIN_ROWS) -> Net | float:
    """The network, or the share of good labels where there are not both kinds (0.5 without any)."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(piece.column("text"), vectors)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary()), piece.column("label"), piece.column("fold")],
            names=["doc_id", "x", "label", "fold"])

    rows = map_texts(labelled_texts(docs, labels, "quality", max_rows), fn,
                     "doc_id long, x binary, label int, fold int").toPandas()  # max_rows short vectors
    rows = rows.sort_values(["doc_id", "x"])
    y, held = rows["label"].to_numpy(dtype=float), (rows["fold"] == 1).to_numpy()
    if not len(y) or not 0 < y[~held].sum() < (~held).sum():
        return float(y.mean()) if len(y) else 0.5
    x = np.frombuffer(b"".join(bytes(b) for b in rows["x"]), dtype=np.float32).reshape(len(y), -1).astype(np.float64)
    return fit(x, y, held)


def quality_scores(docs: DataFrame, labels: DataFrame, predict_from: float = PREDICT_FROM) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs(doc_id, text)."""
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors)

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        if isinstance(net, Net):
            score = net.probability(pooled(piece.column("text"), vectors).astype(np.float64))
        else:
            score = np.full(piece.num_rows, net)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array((score >= predict_from).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text"))
    return map_texts(rows, fn, "doc_id long, held_out boolean, score double, predicted int")
