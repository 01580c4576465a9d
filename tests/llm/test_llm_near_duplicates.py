"""op6: registers, blocks, components, and the whole operator against all pairs."""

import random
import re

import llm_cases as C
import numpy as np
import pyarrow as pa
import pytest
from oracle_harness import compare, duck

from tagloom.llm import components, oracle, queries, setsketch


def shingles(text):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute(rows):
    """doc_id -> (set size, component) by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def test_query_equals_sql(spark):
    name = "op6_setsketch_dedup"
    r = compare(spark, duck(C.SF), name, queries.QUERIES[name], oracle.ORACLE_SQL[name], C.SF)
    assert r["cols_match"] and r["values_match"], r


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(1)
    for share in (0.1, 0.5, 0.75, 0.95):
        n = 3000
        both = rng.integers(0, 2**63, int(n * share)).astype(np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, (n - len(both)) // 2).astype(np.uint64)]) for _ in range(2))
        j = len(both) / (2 * len(a) - len(both))
        ra, rb, rab = (setsketch.sketch(s, np.array([0, len(s)]))[0] for s in (a, b, np.union1d(a, b)))
        assert (setsketch.merge(ra, rb) == rab).all()
        assert abs(setsketch.similarity(len(a), len(b), ra, rb) - j) < 0.15
        assert setsketch.similar_enough(len(a), np.array([len(b)]), ra, rb[None])[0] == (setsketch.similarity(len(a), len(b), ra, rb) >= 0.5)


def test_links_equal_all_pairs():
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        words = base[:]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(words))
    import pyarrow as pa

    sets, bounds = setsketch.shingles_of(pa.array(texts))
    roots = setsketch.linked(sets, bounds, setsketch.sketch(sets, bounds))
    expected = brute(list(enumerate(texts)))
    assert [expected[i][1] for i in range(60)] == roots.tolist()


def hot_group(n=150):
    """Exact copies, a chain of near copies, and texts of their own."""
    rng = random.Random(7)
    base = [f"t{i}" for i in range(50)]
    rows = [(i, " ".join(base)) for i in range(0, n)]
    words = base[:]
    for i in range(n, 2 * n):
        if rng.random() < 0.5:
            words[rng.randrange(50)] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows + [(i, " ".join(f"o{i}_{k}" for k in range(rng.randrange(1, 30)))) for i in range(2 * n, 2 * n + 40)]


@pytest.mark.parametrize("block", [8 << 20, 4000])
def test_hot_groups_whole_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK_BYTES", block)
    rows = hot_group()
    got = setsketch.near_duplicates(C.documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_awkward_and_empty(spark):
    docs = C.documents(spark)
    got = setsketch.near_duplicates(docs).collect()
    assert len(got) == len(C.AWKWARD)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and all(by[i].kept for i in (1, 2, 3, 4, 5, 7, 8, 10))
    assert by[6].component_id == 5 and not by[6].kept and by[9].component_id == 8
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    kept = setsketch.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 10]
    assert setsketch.near_duplicates(docs.limit(0)).count() == 0
    assert setsketch.drop_near_duplicates(docs.limit(0)).count() == 0


def test_a_hot_band_moves_one_row_a_batch():
    n, rng = 500, np.random.default_rng(3)
    keys = rng.integers(-2**62, 2**62, (n, setsketch.BANDS))
    keys[::2, 0], keys[1::5, 3] = 7, 8  # bands that many share
    ids = rng.permutation(n).astype(np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 100].tolist(), pa.list_(pa.int64())), pa.array(ids[a : a + 100])], names=["bands", "u"])
               for a in range(0, n, 100)]
    rows = pa.Table.from_batches(list(setsketch._batch_stars(iter(batches)))).to_pylist()
    assert sum(r["key"] == 7 and r["v"] is None for r in rows) == 5
    rows.sort(key=lambda r: (r["v"] is not None, r["key"], r["u"]))
    moved = [pa.RecordBatch.from_pylist(rows[a : a + 999], pa.schema([(c, pa.int64()) for c in ("key", "u", "v")])) for a in range(0, len(rows), 999)]
    up = {i: i for i in range(n)}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for batch in setsketch._band_stars(iter(moved)):
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            assert v < u
            x, y = sorted((root(u), root(v)))
            up[y] = x
    groups = [set(ids[::2].tolist()), set(ids[1::5].tolist())]
    groups = [groups[0] | groups[1]] if groups[0] & groups[1] else groups
    for i in range(n):
        assert root(i) == next((min(g) for g in groups if i in g), i)


def test_a_text_of_a_repeated_id_goes_only_with_its_own_copy(spark):
    own = "nothing else in the table has the words that are in this text of the repeated id"
    docs = C.documents(spark, [(1, C.SHARED), (7, C.SHARED), (7, own), (7, own), (8, C.SHARED), (9, None), (9, C.SHARED), (None, C.SHARED)])
    kept = setsketch.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("1", C.SHARED), ("7", own), ("9", "None"), ("None", C.SHARED)])


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 203)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
