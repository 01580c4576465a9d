"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor (op13).

Vectors become integers, ``x = floor(64 c) + 1000000``. A first pass sums them exactly; a second sums the
products of the centred vectors, task by task, row of the matrix by row. The d by d scatter, the only
thing the driver sees (its size is the dimension's, not the table's), is factored as L L' by Cholesky
steps with the largest remaining pivot; one-sided Jacobi then rotates the columns of that triangular
factor until they are orthogonal: their squared norms are the scatter's eigenvalues, the columns over
their norms its eigenvectors. A third pass measures the whitened vectors' covariance, a fourth projects.

Defined results: rows with a null vector, or a null, NaN or infinite entry, give nothing. So do vectors of
another length than most have (of equally frequent lengths the greater counts) and empty ones. A null
vec_id and repeated rows come out like others. Entries whose integer lies beyond +-2^61 stand at that bound; a deviation beyond
a long is null. Directions without variance cannot be whitened, so a table of rank r gives the first
min(r, 32) components, and a table of one vector or of equal ones gives no rows. Components are signed
so that their largest entry is positive. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.batches import map_arrow

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
BOUND = 2.0**61
ROWS = 4096  # vectors that are worked on at a time


class Whitening(NamedTuple):
    n: int
    sums: list[int]  # of each dimension, exact
    components: np.ndarray  # one a row
    eigenvalues: np.ndarray  # of the covariance, falling
    trace: float


def integers(column: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that count, their lengths, their integers one after the other) of a column of vectors."""
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths().fill_null(0)), 0)
    flat = column.flatten()  # leaves null vectors out
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry reads as NaN
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if dimension is not None:
        good &= lengths == dimension
    values = values[np.repeat(good, lengths)]
    return np.flatnonzero(good), lengths[good], np.clip(np.floor(SCALE * values), -BOUND, BOUND).astype(np.int64) + SHIFT


def matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(vec_ids, x-vectors) of the rows that count, a bounded number at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            piece = batch.slice(a, ROWS)
            at, _, x = integers(piece.column("embedding"), dimension)
            if len(at):
                yield piece.column("vec_id").take(pa.array(at)), x.reshape(-1, dimension)


def moments(vectors: DataFrame) -> tuple[int, list[int]]:
    """(n, sums of each dimension) over the rows that count, exact."""

    def fn(batches):
        n: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                _, lengths, x = integers(batch.column("embedding").slice(a, ROWS))
                own = np.repeat(lengths, lengths)
                for d in np.unique(lengths).tolist():
                    rows = x[own == d].reshape(-1, d)
                    # sums of halves: neither leaves a long in a task
                    part = np.stack([(rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0)])
                    n[d], totals[d] = n.get(d, 0) + len(rows), totals.get(d, 0) + part
        for d, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d), pa.array(range(d)), pa.array([n[d]] * d), pa.array(total[0]), pa.array(total[1])],
                names=["d", "i", "n", "high", "low"])

    parts = map_arrow(vectors, fn, "d long, i long, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    whole = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), *exact)
    common = whole.where("i = 0").orderBy(F.desc("n"), F.desc("d")).select("d").limit(1)
    rows = sorted(whole.join(F.broadcast(common), "d").collect(), key=lambda r: r["i"])  # a row for each dimension
    return (rows[0]["n"] if rows else 0), [int(r["high"]) * 2**32 + int(r["low"]) for r in rows]


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S/n, the whole part taken off as integers first."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def summed(vectors: DataFrame, rows_of, width: int) -> np.ndarray:
    """The sum over tasks of width by width matrices: ``rows_of(batches)`` gives a task's."""

    def task(batches):
        m = rows_of(batches)
        if m is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width)), pa.array(list(m), pa.list_(pa.float64()))], names=["i", "part"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("i").to_pylist(), batch.column("part")):
                totals[i] = totals.get(i, 0) + part.values.to_numpy()
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(totals), pa.array([t for t in totals.values()], pa.list_(pa.float64()))], names=["i", "part"])

    parts = map_arrow(vectors, task, "i long, part array<double>").repartition("i")
    out = np.zeros((width, width))
    for row in map_arrow(parts, add, "i long, part array<double>").collect():  # a row for each dimension
        out[row["i"]] = row["part"]
    return (out + out.T) / 2


def scatter(vectors: DataFrame, sums: list[int], n: int) -> np.ndarray:
    """Sum of the outer products of the centred vectors."""
    d = len(sums)

    def rows_of(batches):
        total = None
        for _, x in matrices(batches, d):
            c = centred(x, sums, n)
            total = c.T @ c + (0 if total is None else total)
        return total

    return summed(vectors, rows_of, d)


def pivoted_cholesky(a: np.ndarray, tolerance: float = 1e-13) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): a[order][:, order] = L L' with L lower trapezoidal; pivots below tolerance times the first end it."""
    a, d = a.copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    first, rank = (a.diagonal().max() if d else 0.0), 0
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > tolerance * first:
            break
        for m in (a, a.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
        rank += 1
    return factor[:, :rank], order


def one_sided_jacobi(m: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """m with its columns rotated in pairs until all are orthogonal to working precision."""
    m = m.copy()
    for _ in range(sweeps):
        turned = False
        for p in range(m.shape[1] - 1):
            for q in range(p + 1, m.shape[1]):
                x, y = m[:, p], m[:, q]
                both, xx, yy = x @ y, x @ x, y @ y
                if abs(both) <= 1e-15 * np.sqrt(xx * yy):
                    continue
                turned = True
                z = (yy - xx) / (2 * both)
                t = np.copysign(1.0, z) / (abs(z) + np.hypot(1.0, z))
                c = 1 / np.hypot(1.0, t)
                m[:, p], m[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    return m


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows) of a positive semidefinite matrix, of its positive eigenvalues."""
    factor, order = pivoted_cholesky(a)
    rows = np.empty_like(factor)
    rows[order] = one_sided_jacobi(factor)
    norms = np.linalg.norm(rows, axis=0)
    by = np.argsort(-norms, kind="stable")
    vectors = (rows[:, by] / norms[by]).T
    largest = np.argmax(np.abs(vectors), axis=1)
    return norms[by] ** 2, vectors * np.sign(vectors[np.arange(len(vectors)), largest])[:, None]


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of vectors(vec_id, embedding), or None if there is nothing to whiten."""
    n, sums = moments(vectors)
    if not n:
        return None
    a = scatter(vectors, sums, n)
    values, components = eigen(a)
    if not len(values):
        return None
    return Whitening(n, sums, components[:most], values[:most] / n, float(np.trace(a)) / n)


def project(x: np.ndarray, w: Whitening) -> np.ndarray:
    return centred(x, w.sums, w.n) @ w.components.T / np.sqrt(w.eigenvalues)


def deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2 for each row; None beyond a long."""
    top = max(float(np.abs(x).max()) * w.n, max(abs(float(s)) for s in w.sums)) * 2
    if top < 2.0**62 and len(w.sums) * float(np.abs(x * w.n - np.array(w.sums)).max()) ** 2 < 2.0**62:
        return ((x * w.n - np.array(w.sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((w.n * v - s) ** 2 for v, s in zip(row, w.sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""

    def rows_of(batches):
        total = None
        for _, x in matrices(batches, len(w.sums)):
            y = project(x, w)
            total = y.T @ y + (0 if total is None else total)
        return total

    k = len(w.eigenvalues)
    return float(np.abs(summed(vectors, rows_of, k) / w.n - np.eye(k)).max())


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row that counts and component."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    w = fit(rows, most)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return rows.sparkSession.createDataFrame([], schema)
    k, error = len(w.eigenvalues), identity_error(rows, w)

    def fn(batches):
        for ids, x in matrices(batches, len(w.sums)):
            y, m = project(x, w), len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                 pa.array(deviations(x, w), pa.int64()).take(pa.array(each)), pa.array(y.ravel()),
                 pa.array(np.tile(w.eigenvalues / w.trace, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(rows, fn, schema)
