"""op12: cells, trees and blocks, and the whole operator against all pairs."""

import random
import re

import llm_cases as C
import numpy as np
import pyarrow as pa
import pytest
from oracle_harness import compare, duck

from tagloom.llm import ngram_rtree as N
from tagloom.llm import oracle, queries


def tokens(text):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) or frozenset([tuple(words)])


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)


def brute(rows):
    """doc_id -> (set size, component) by all pairs."""
    sets = [(i, tokens(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if linked(a, b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def edited(rng, base, edits, spread=10**6):
    words = base[:]
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(spread)}"
    return " ".join(words)


def mixed(seed=3):
    """Chains of edits over the threshold, hubs of near copies with outliers, stock texts with half in common, lone texts."""
    rng = random.Random(seed)
    rows = []
    for size in (6, 9, 14, 60, 400):
        base = [f"b{size}_{i}" for i in range(size)]
        for _ in range(40):
            rows.append(edited(rng, base, rng.randrange(0, 3 + size // 60)))
        for _ in range(15):  # a chain: each is an edit of the one before
            base = edited(rng, base, 1 + size // 90).split()
            rows.append(" ".join(base))
        for cut in range(1, 5):
            rows.append(" ".join(base[cut:]))
    stock = [f"s{i}" for i in range(80)]
    rows += [" ".join(stock + [f"o{k}_{i}" for i in range(80)]) for k in range(40)]
    rows += [" ".join(f"l{k}_{i}" for i in range(rng.randrange(1, 40))) for k in range(40)]
    rows += rows[:20]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_query_equals_sql(spark):
    name = "op12_count_vector_rtree"
    r = compare(spark, duck(C.SF), name, queries.QUERIES[name], oracle.ORACLE_SQL[name], C.SF)
    assert r["cols_match"] and r["values_match"], r


def test_similar_sets_share_a_cell():
    texts = [t for _, t in mixed()]
    sets, bounds = N.token_sets(pa.array(texts))
    plain = [tokens(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in plain]
    cells = [set(c.tolist()) for c in N.cells(sets, bounds)]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if plain[i] != plain[j] and linked(plain[i], plain[j])]
    assert len(pairs) > 500 and all(cells[i] & cells[j] for i, j in pairs)


def test_sets_whose_agreeing_slices_are_empty_share_a_cell():
    """Tokens in one slice alone: all other slices are empty in both sets."""
    a = np.arange(1, 15, dtype=np.uint64)
    sets = np.concatenate([a, a[1:]])
    one, two = N.cells(sets, np.array([0, 14, 27]))
    assert set(one.tolist()) & set(two.tolist())


def test_classes_have_more_slices_than_partners_differ_in():
    low = N.size_classes(9000)
    label = np.searchsorted(low, np.arange(9001), side="right") - 1
    for n in range(1, 4000):
        for partner in (n, n * 100 // 85):
            slices, spare = N.slices_of(int(label[partner]), low)
            assert slices - spare > (n + partner) * 15 // 185


def test_cells_shared_within_and_across_batches():
    rng = np.random.default_rng(4)
    own = [np.unique(np.concatenate([rng.integers(-2**62, 2**62, 5), [7] if i % 2 else [], [i % 11 + 100]]).astype(np.int64)) for i in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 60)), pa.array([c.tolist() for c in own[a : a + 60]], pa.list_(pa.int64()))], names=["node", "cells"])
               for a in range(0, 300, 60)]
    rows = pa.Table.from_batches(list(N._packed(4)(iter(batches))))
    hot = sum(np.frombuffer(r["cells"], np.int64).tolist().count(7) for r in rows.to_pylist() if r["part"] < 4)
    assert hot == 5  # one pair a batch
    got = pa.Table.from_batches(list(N._shared(4)(iter(rows.sort_by("part").to_batches()))))
    holders = {}
    for i, c in enumerate(own):
        for x in c.tolist():
            holders.setdefault(x, set()).add(i)
    assert set(zip(*got.to_pydict().values())) == {(c, i) for c, nodes in holders.items() if len(nodes) > 1 for i in nodes}


def test_copies_alone_share_no_cell():
    """Copies bring equal (cell, tag) pairs, in one batch or in several."""
    batches = [pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(own, pa.list_(pa.int64()))], names=["node", "cells"])
               for nodes, own in (([1, 1, 2], [[5, 6], [5, 6], [6]]), ([1, 3], [[5, 6], [8]]), ([3, 3], [[8], [8]]))]
    rows = pa.Table.from_batches(list(N._packed(2)(iter(batches))))
    got = pa.Table.from_batches(list(N._shared(2)(iter(rows.sort_by("part").to_batches()))))
    assert set(zip(*got.to_pydict().values())) == {(6, 1), (6, 2)}


def test_tokens_that_agree_in_their_last_bits_alone_share_no_cell():
    one = np.arange(256, dtype=np.uint64) << np.uint64(56)  # some in every slice
    sets = np.concatenate([one, one | np.uint64(1 << 20)])
    a, b = N.cells(sets, np.array([0, 256, 512]))
    assert len(a) > 30 and not set(a.tolist()) & set(b.tolist())


def test_cells_are_packed_where_they_are_made(spark, monkeypatch):
    """Rows with their cells are neither joined nor dealt anew before they are packed."""

    class Seen(Exception):
        pass

    def seen(df, name, *more, cut=N.cut_lineage):
        if name == "ngram-held":
            raise Seen(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, name, *more)

    monkeypatch.setattr(N, "cut_lineage", seen)
    with pytest.raises(Seen) as plan:
        N.ngram_join(C.documents(spark))
    below = str(plan.value).split("MapInArrow")[2]  # what stands under the packing, to its first table
    below = below[: below.index("Relation") + below[below.index("Relation") :].index("parquet")]
    assert "cells" in below and "Join" not in below and "Repartition" not in below


def test_fine_points_rule_hub_pairs_out():
    """Sets whose coarse points are equal and whose fine points are not; a similar pair stays."""
    coarse = np.arange(1200, dtype=np.uint64) % np.uint64(N.GROUPS)
    a, b = (np.unique(coarse + np.uint64(N.GROUPS) * (np.arange(1200, dtype=np.uint64) * np.uint64(2) + np.uint64(k))) for k in (0, 1))
    sets, bounds = np.concatenate([a, b, a[:-20]]), np.cumsum([0, 1200, 1200, 1180])
    point, fine = [p.tobytes() for p in N.points(sets, bounds)], N.fine_points(sets, bounds)
    assert point[0] == point[1]
    rows = [{"node": x, "hub": 0, "n_shingles": int(bounds[x + 1] - bounds[x]), "hub_shingles": 1200, "point": point[x], "hub_point": point[0],
             "fine": fine[x], "hub_fine": fine[0]} for x in (1, 2)]
    got = [r for batch in N._likely_stars(iter(pa.Table.from_pylist(rows).to_batches())) for r in batch.to_pylist()]
    assert got == [{"node": 2, "hub": 0}]


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(8)
    centre = rng.integers(0, 9, (30, N.GROUPS))
    point = (centre[rng.integers(0, 30, 900)] + (rng.random((900, N.GROUPS)) < 0.05)).astype(np.int64)
    size = point.sum(axis=1)
    tree = N.CountTree(point, size)
    assert sorted(tree.order.tolist()) == list(range(900)) and len(tree.levels) > 1
    visited = 0
    for x in range(0, 900, 7):
        bound = np.minimum(point, point[x]).sum(axis=1)
        want = np.flatnonzero(N.similar(bound, size, size[x]))
        assert sorted(tree.search(point[x], int(size[x])).tolist()) == want.tolist()
        corner, least, most, *_ = tree.levels[0]
        visited += int(N.similar(np.minimum(np.minimum(corner, point[x]).sum(axis=1), np.minimum(most, size[x])), size[x], least).sum())
    assert visited < 0.5 * len(range(0, 900, 7)) * len(tree.levels[0][0])  # pages are pruned


def test_small_and_large_blocks_allow_the_same(monkeypatch):
    """Blocks over batch borders; with pages of one row all but the smallest go through trees."""
    rng = np.random.default_rng(9)
    rows = []
    for cell in range(40):
        point = rng.integers(0, 4, (6, N.GROUPS))
        for n in range(int(rng.integers(2, 50))):
            p = (point[rng.integers(0, 6)] + (rng.random(N.GROUPS) < 0.05)).astype(np.uint16)
            rows.append({"cell": cell, "a": 0, "b": 0, "side": n % 2, "node": len(rows), "component": int(rng.integers(0, 250)), "n_shingles": int(p.sum()), "point": p.tobytes()})
    rows.sort(key=lambda r: (r["cell"], r["side"]))
    table = pa.Table.from_pylist(rows)
    want = set()
    for x in rows:
        for y in rows:
            if (x["cell"], x["side"], y["side"]) == (y["cell"], 0, 1) and x["component"] != y["component"]:
                a, b = (np.frombuffer(r["point"], np.uint16).astype(int) for r in (x, y))
                if N.similar(np.minimum(a, b).sum(), x["n_shingles"], y["n_shingles"]):
                    want.add(tuple(sorted((x["component"], y["component"]))))
    forests = []
    for leaf, step in ((32, 17), (32, 5000), (1, 64)):
        monkeypatch.setattr(N, "LEAF", leaf)
        got = {(u, v) for b in N._may_join(iter(table.to_batches(max_chunksize=step))) for u, v in zip(b["u"].to_pylist(), b["v"].to_pylist())}
        assert got <= want and (leaf == 1 or got == want)
        up = {c: c for c in range(250)}

        def root(c):
            while up[c] != c:
                c = up[c]
            return c

        for u, v in got:
            up[max(root(u), root(v))] = min(root(u), root(v))
        forests.append([root(c) for c in range(250)])
    assert forests[0] == forests[1] == forests[2] and want


def test_fine_points_bound_what_sets_share():
    rng = np.random.default_rng(13)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:n][rng.random(n) < keep], rng.integers(0, 2**63, 40).astype(np.uint64)]))
            for n in (50, 200, 900, 3000, 3000) for keep in (1.0, 0.9, 0.5)]
    bounds = np.cumsum([0, *map(len, sets)])
    raw = N.fine_points(np.concatenate(sets), bounds)
    assert [len(r) for r in raw] == [N.fine_groups(len(s)) for s in sets] and len({len(r) for r in raw}) > 3
    fine, ys = N.FinePoints(pa.array(raw)), np.arange(len(sets))
    for x, a in enumerate(sets):
        most = fine.shared(x, ys)
        for y, b in enumerate(sets):
            counts = [np.bincount((s % np.uint64(min(len(raw[x]), len(raw[y])))).astype(int), minlength=min(len(raw[x]), len(raw[y]))) for s in (a, b)]
            assert most[y] == np.minimum(*counts).sum() >= len(np.intersect1d(a, b))
    full = N.FinePoints(pa.array([bytes([255] * 64), bytes([255] * 128)]))
    assert full.shared(0, np.array([0, 1])).min() >= 64 << 20


def test_a_full_coordinate_never_rules_out():
    full = np.array([[N.FULL] + [1] * (N.GROUPS - 1)] * 2, dtype=np.uint16)
    point = N.unpacked(pa.array([r.tobytes() for r in full]))
    assert N.CountTree(point, np.array([10**6, 10**6])).search(point[0], 10**6).tolist() == [0, 1]


@pytest.mark.parametrize("rows,size", [(N.BLOCK_ROWS, N.BLOCK_BYTES), (16, 3000)])
def test_whole_operator_equals_all_pairs(spark, monkeypatch, rows, size):
    monkeypatch.setattr(N, "BLOCK_ROWS", rows)
    monkeypatch.setattr(N, "BLOCK_BYTES", size)
    docs = mixed()
    got = N.ngram_join(C.documents(spark, docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs) and len(got) == len(docs)


def test_a_group_whose_hub_links_few(spark):
    """A long chain: every text shares cells with the least, few link with it."""
    rng = random.Random(11)
    words = [f"c{i}" for i in range(100)]
    docs = []
    for k in range(120):
        docs.append((k, " ".join(words)))
        words[rng.randrange(100)] = f"n{k}"
    got = N.ngram_join(C.documents(spark, docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


def test_awkward_and_empty(spark):
    docs = C.documents(spark)
    got = N.ngram_join(docs).collect()
    assert len(got) == len(C.AWKWARD) and got[0].asDict().keys() == {"doc_id", "n_shingles", "component_id"}
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert {i: by[i].component_id for i in by} == {i: i for i in range(1, 11)} | {6: 5, 9: 8}
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert N.ngram_join(docs.limit(0)).count() == 0


def test_an_id_with_several_texts(spark):
    near = C.SHARED.replace("evening", "morning")
    other = " ".join(f"w{i}" for i in range(30))
    docs = C.documents(spark, [(1, C.SHARED + " a b c d e f g"), (7, C.SHARED + " a b c d e f h"), (7, other), (7, other), (9, other + " x"), (12, near)])
    got = sorted((r.doc_id, r.component_id) for r in N.ngram_join(docs).collect())
    assert got == [(1, 1), (7, 1), (7, 1), (7, 1), (9, 1), (12, 12)]
