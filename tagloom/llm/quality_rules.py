"""Quality rules (op2): text statistics, and a hashed n-gram logistic regression with calibrated probabilities.

Features are the frequencies of word 1- and 2-grams and of character 3-grams, each hashed into a
fixed number of buckets. The regression is fitted on a bounded sample of labelled rows
(``TRAIN_ROWS``) that pass the base rules, its scores become probabilities by Platt scaling on a fold it never saw, and every
document is scored in Arrow batches; one below ``KEEP_FROM`` is rejected.

Defined results: null, empty and wordless texts have no words and fail the base rules; repeated rows
and null ids are judged row by row. Without usable labels of both kinds there is no model and the
base rules decide alone (score null).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import map_arrow, map_texts, text_slices
from tagloom.llm.samples import labelled_texts

WORD_BUCKETS = CHAR_BUCKETS = 1 << 15
BUCKETS = 2 * WORD_BUCKETS + CHAR_BUCKETS
TRAIN_ROWS = 3000
KEEP_FROM = 0.3
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SCALE = 50.0  # frequencies are small; scaled so that weights of order one matter

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.zeros(256, dtype=bool)
_NOT_NEWLINE[0x0A] = True  # the separator of lines


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])


def base_statistics(data: np.ndarray, offsets: np.ndarray, w: textvec.Words, wh: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    space = textvec.IS_SPACE[data]
    n = len(offsets) - 1
    dup_lines, repeated = np.zeros(n, np.int64), np.zeros(n, np.int64)

    lines = textvec.words(data, offsets, _NOT_NEWLINE)
    solid = np.concatenate(([0], np.cumsum(~space)))
    filled = solid[lines.ends] > solid[lines.starts]
    hashes = lines.hashes()
    for i in np.flatnonzero(lines.counts > 1).tolist():
        a, b = lines.bounds[i], lines.bounds[i + 1]
        h = hashes[a:b][filled[a:b]]
        dup_lines[i] = len(h) - len(np.unique(h))

    runs, at = textvec.windows(wh, w.bounds, WINDOW)
    cut = np.searchsorted(at, w.bounds)
    for i in np.flatnonzero(np.diff(cut) > 1).tolist():
        h = runs[cut[i] : cut[i + 1]]
        s = np.sort(h)
        again = s[1:][s[1:] == s[:-1]]
        if len(again):
            first = np.flatnonzero(np.isin(h, again))
            cover = np.zeros(len(h) + WINDOW, np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, first + WINDOW, -1)
            repeated[i] = np.count_nonzero(np.cumsum(cover))
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
    }


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Texts that the fixed rules reject whatever the model says."""
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEATED_PERCENT * stats["n_words"])


def grams(data: np.ndarray, offsets: np.ndarray, w: textvec.Words, wh: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: buckets of all n-grams, and bounds of each text's."""
    out = [((wh >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS, w.bounds)]
    pairs, at = textvec.windows(wh, w.bounds, 2)
    out.append((WORD_BUCKETS + (pairs >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS, np.searchsorted(at, w.bounds)))
    d = data.astype(np.uint32)
    tri = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)) if len(d) > 2 else d[:0]
    tri = ((tri ^ (tri >> np.uint32(15))) * np.uint32(0x27D4EB2F)) >> np.uint32(17)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = text_of[:-2] == text_of[2:] if len(d) > 2 else np.zeros(0, bool)
    place = np.concatenate(([0], np.cumsum(inside)))
    out.append((2 * WORD_BUCKETS + tri[inside].astype(np.int64) % CHAR_BUCKETS, place[np.minimum(offsets, len(place) - 1)]))
    return out


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(values)))[bounds])


@dataclass
class Model:
    weights: np.ndarray  # one for each bucket
    bias: float
    slope: float = 1.0  # Platt scaling of the score
    shift: float = 0.0

    def score(self, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Raw scores of texts."""
        z = np.full(len(kinds[0][1]) - 1, self.bias)
        for buckets, bounds in kinds:
            z += SCALE * _sums(self.weights[buckets], bounds) / np.maximum(np.diff(bounds), 1)
        return z

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic map from scores to labels, by Newton steps with a weak prior at 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, w = p - y, p * (1 - p) + 1e-6
        g = np.array([np.dot(r, z) + 0.1 * (a - 1), r.sum() + 0.1 * b])
        h = np.array([[np.dot(w, z * z) + 0.1, np.dot(w, z)], [np.dot(w, z), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(index: np.ndarray, value: np.ndarray, bounds: np.ndarray, y: np.ndarray, held: np.ndarray,
        steps: int = 100, decay: float = 1e-4) -> Model:
    """Logistic regression by accelerated gradient steps on rows not held, calibrated on held ones."""
    row = np.repeat(np.arange(len(y)), np.diff(bounds))
    used = ~held
    share = used / max(used.sum(), 1)
    # the mean squared length of a row bounds the curvature, so this step cannot overshoot
    rate = 4 / (1 + np.dot(_sums(value.astype(float) ** 2, bounds), share))
    w, b = np.zeros(BUCKETS), float(np.log((y[used].sum() + 1) / ((1 - y[used]).sum() + 1)))
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        z = _sums(value * ahead_w[index], bounds) + ahead_b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        new_w = ahead_w - rate * (np.bincount(index, weights=value * r[row], minlength=BUCKETS) + decay * ahead_w)
        new_b = ahead_b - rate * r.sum()
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new_w + (t - 1) / grown * (new_w - w), new_b + (t - 1) / grown * (new_b - b)
        w, b, t = new_w, new_b, grown
    model = Model(w.astype(np.float32), b)
    z = _sums(value * w[index], bounds) + b
    if held.any() and 0 < y[held].mean() < 1:
        model.slope, model.shift = _platt(z[held], y[held])
    return model


def _prepared(values) -> tuple[np.ndarray, np.ndarray, textvec.Words, np.ndarray]:
    data, offsets = textvec.flat(values)
    w = textvec.words(data, offsets)
    return data, offsets, w, w.hashes()


def _features(batches):
    for batch in batches:
        for piece in text_slices(batch):
            data, offsets, w, wh = _prepared(piece.column("text"))
            piece_failed = base_failed(base_statistics(data, offsets, w, wh))
            kinds = grams(data, offsets, w, wh)
            index, value = [], []
            for i in range(piece.num_rows):
                ix, vs = [], []
                for buckets, bounds in kinds:
                    own = buckets[bounds[i] : bounds[i + 1]]
                    u, n = np.unique(own, return_counts=True)
                    ix.append(u)
                    vs.append(SCALE * n / max(len(own), 1))
                index.append(np.concatenate(ix).astype(np.int32))
                value.append(np.concatenate(vs).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in index], pa.binary()), pa.array([x.tobytes() for x in value], pa.binary()),
                 piece.column("label"), piece.column("fold")],
                names=["index", "value", "label", "fold"]).filter(pa.array(~piece_failed))


def _fit_task(batches):
    rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("index", "value", "label", "fold")))]
    rows.sort()  # the same model whatever the order of arrival
    y = np.array([r[2] for r in rows], dtype=float)
    held = np.array([r[3] == 1 for r in rows], dtype=bool)
    if not rows or not 0 < y[~held].sum() < (~held).sum():
        return
    index = np.frombuffer(b"".join(r[0] for r in rows), dtype=np.int32)
    value = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.float32)
    bounds = np.concatenate(([0], np.cumsum([len(r[0]) // 4 for r in rows])))
    model = fit(index, value, bounds, y, held)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()], pa.binary()), pa.array([[model.bias, model.slope, model.shift]])],
        names=["weights", "numbers"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Model | None:
    """The calibrated model of a bounded sample, fitted in one task; None without both labels."""
    rows = map_arrow(
        labelled_texts(docs, labels, "quality", max_rows), _features, "index binary, value binary, label int, fold int")
    got = map_arrow(rows.repartition(1), _fit_task, "weights binary, numbers array<double>").collect()
    if not got:
        return None
    return Model(np.frombuffer(bytes(got[0]["weights"]), dtype=np.float32), *got[0]["numbers"])


def judge(values, model: Model | None, keep_from: float = KEEP_FROM) -> dict[str, np.ndarray]:
    """Statistics, base verdict, probability of good quality and final verdict of texts."""
    data, offsets, w, wh = _prepared(values)
    out = base_statistics(data, offsets, w, wh)
    out["base_failed"] = base_failed(out)
    p = model.probability(model.score(grams(data, offsets, w, wh))) if model else np.full(len(offsets) - 1, np.nan)
    out["probability"] = p
    out["kept"] = ~out["base_failed"] & ~(p < keep_from)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Verdict and statistics of every row of docs(doc_id, text)."""
    model = train(docs, labels)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        got = judge(piece.column("text"), model, keep_from)
        p = pa.array(got["probability"], mask=np.isnan(got["probability"]))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(got[n]) for n in names), p],
                                          names=["doc_id", *names, "probability"])

    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), fn,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, "
                     "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double")


def keep_good(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    model = train(docs, labels)

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.filter(pa.array(judge(piece.column("text"), model, keep_from)["kept"]))

    return map_texts(docs, fn, docs.schema)
