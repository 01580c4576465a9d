"""op13: factorisation and rotation against numpy's, and the whole operator against a plain version."""

import llm_cases as C
import numpy as np
import pytest

from tagloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, component int"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(i + first, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for i, v in enumerate(vectors)], SCHEMA)


def plain(vectors, most=32):
    """(x, components by falling eigenvalue, eigenvalues, trace) by numpy's own decomposition."""
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1000000
    c = x - x.sum(axis=0) / len(x)
    cov = c.T @ c / len(x)
    e, u = np.linalg.eigh(cov)
    return x, c, e[::-1][:most], u[:, ::-1][:, :most], np.trace(cov)


def same(got, ids, vectors, most=32):
    x, c, e, u, trace = plain(vectors, most)
    n, total = len(x), x.sum(axis=0)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert sorted(by) == sorted(ids)
    white = np.array([[r.whitened for r in sorted(by[i], key=lambda r: r.component)] for i in ids])
    want = c @ u / np.sqrt(e)
    signs = np.sign((white * want).sum(axis=0))  # one for all rows
    assert np.allclose(white, want * signs, atol=1e-7)
    for at, i in enumerate(ids):
        rows = sorted(by[i], key=lambda r: r.component)
        assert [r.component for r in rows] == list(range(1, len(e) + 1))
        assert {r.n for r in rows} == {n} and {r.deviation for r in rows} == {sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[at], total))}
        assert np.allclose([r.explained for r in rows], e / trace, rtol=1e-9)
    assert max(r.identity_error for r in got) < 1e-9


def test_query_equals_numpy(spark):
    rows = C.read("embeddings", ["vec_id", "embedding"])
    same(queries.op13_cholesky_jacobi_whitening(spark, C.SF).collect(), [i for i, _ in rows], [v for _, v in rows])


def test_pivoted_cholesky_and_jacobi():
    rng = np.random.default_rng(5)
    for d, rank in ((1, 1), (7, 7), (20, 6)):
        m = rng.normal(size=(d, rank)) * np.logspace(0, -4, rank)
        a = m @ m.T
        factor, order = whitening.pivoted_cholesky(a)
        assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, a[order][:, order], atol=1e-12)
        assert (np.triu(factor[:rank], 1) == 0).all() and (np.diff(np.abs(factor[:rank].diagonal())) <= 1e-12).all()
        turned = whitening.one_sided_jacobi(factor)
        gram = turned.T @ turned
        assert np.abs(gram - np.diag(gram.diagonal())).max() <= 1e-13 * gram.max()
        values, vectors = whitening.eigen(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-14)
        assert np.allclose(vectors @ vectors.T, np.eye(rank), atol=1e-9) and np.allclose(vectors @ a, values[:, None] * vectors, atol=1e-10)
    assert whitening.eigen(np.zeros((3, 3)))[0].size == 0


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(30, 5)).tolist()
    bad = [None, [], [1.0] * 4, [1.0, None, 2, 3, 4], [float("nan")] * 5, [1, 2, 3, 4, float("inf")], [0.0] * 6]
    rows = frame(spark, good + bad).union(frame(spark, good[:1], 1000)).union(spark.createDataFrame([(None, good[1], 1, 2)], SCHEMA))
    got = rows.transform(whitening.whiten).collect()
    kept = good + good[:1] + good[1:2]
    _, _, e, _, trace = plain(kept)
    assert {r.n for r in got} == {32} and len(got) == 32 * 5
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [*range(30), 1000] and sum(r.vec_id is None for r in got) == 5
    assert np.allclose(sorted({r.explained for r in got}, reverse=True), e / trace)


def test_few_dimensions_low_rank_and_nothing(spark):
    rng = np.random.default_rng(2)
    flat = rng.integers(-9, 9, (40, 2)) @ rng.integers(-3, 3, (2, 6))
    got = whitening.whiten(frame(spark, flat.tolist())).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-9
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]):
        empty = whitening.whiten(frame(spark, vectors))
        assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_is_exact_or_null(spark):
    big = [[1e9, 0.5], [-1e9, 0.25], [1e300, 3.0]]
    got = {(r.vec_id, r.deviation) for r in whitening.whiten(frame(spark, big)).collect()}
    assert {i for i, _ in got} == {0, 1, 2} and all(d is None for _, d in got)
    near = [[1e6, 0.5], [-1e6, 0.25], [3e5, -7.0]]
    x = [[int(np.floor(64 * v)) + 1000000 for v in row] for row in near]
    s = [sum(c) for c in zip(*x)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, near)).collect()}
    assert got == {i: sum((3 * v - t) ** 2 for v, t in zip(row, s)) for i, row in enumerate(x)}


@pytest.mark.parametrize("n", [1, 10**9])
def test_centring_keeps_small_differences(n):
    sums = [1000000 * n + n // 3, 999999 * n]
    got = whitening.centred(np.array([[1000001, 999999]]), sums, n)
    assert np.allclose(got, [[1 - (n // 3) / n, 0.0]], atol=1e-15)
