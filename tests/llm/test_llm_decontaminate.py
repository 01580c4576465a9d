"""op5: greedy string tiling against a direct version, planted leaks, awkward tables."""

import re

import llm_cases as C
import numpy as np
import pyarrow as pa

from tagloom.llm import decontaminate as D
from tagloom.llm import queries


def brute_tiles(doc, item, least):
    """Greedy string tiling by looking at all pairs of places."""
    tiles, used_d, used_i = [], [0] * len(doc), [0] * len(item)
    while True:
        best, found = least - 1, []
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and not used_d[d + k] and not used_i[i + k]:
                    k += 1
                if k > best:
                    best, found = k, [(d, i)]
                elif k == best and k >= least:
                    found.append((d, i))
        if best < least:
            return tiles
        for d, i in found:
            if not any(used_d[d : d + best]) and not any(used_i[i : i + best]):
                used_d[d : d + best] = [1] * best
                used_i[i : i + best] = [1] * best
                tiles.append((d, i, best))


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def test_tiles_random():
    rng = np.random.default_rng(0)
    for _ in range(300):
        v = int(rng.integers(1, 6))
        doc, item = ((rng.integers(0, v, n).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                     for n in (rng.integers(0, 40), rng.integers(1, 25)))
        assert sorted(t[2] for t in D.tile(doc, item, 3)) == sorted(t[2] for t in brute_tiles(doc.tolist(), item.tolist(), 3))


def test_query_against_brute_force(spark):
    docs, items = C.read("documents", ["doc_id", "text"]), C.read("benchmark", ["item_id", "text"])
    expected = set()
    for item_id, text in items:
        item = tokens(text)
        seeds = {tuple(item[i : i + D.MIN_MATCH]) for i in range(len(item) - D.MIN_MATCH + 1)}
        for doc_id, t in docs:
            doc = tokens(t)
            near = sorted({k for i in range(len(doc) - D.MIN_MATCH + 1) if tuple(doc[i : i + D.MIN_MATCH]) in seeds
                           for k in range(i, i + D.MIN_MATCH)})
            if 2 * len(near) >= len(item):
                part = [doc[k] if k in set(near) else None for k in range(near[0], near[-1] + 1)]
                part = [x if x is not None else object() for x in part]
                covered = sum(x[2] for x in brute_tiles(part[:400], item, D.MIN_MATCH))
                if covered >= D.COVERAGE * len(item):
                    expected.add((doc_id, item_id, len(item), covered))
    got = {(r.doc_id, r.item_id, r.item_tokens, r.covered_tokens) for r in queries.op5_string_tiling_decontamination(spark, C.SF).collect()}
    assert got == expected and expected


PASSAGE = ("Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu nu! Xi omicron pi rho sigma tau upsilon. "
           "Phi chi psi omega then one two three four five.")


def test_planted_leaks(spark):
    parts = re.findall(r"[^.!]+[.!]", PASSAGE)
    filler = " ".join(f"word{i}" for i in range(300))
    docs = C.documents(spark, [
        (1, f"{filler} {PASSAGE} {filler}"), (2, PASSAGE.upper().replace(" ", "\n")), (3, f"{parts[2]} {filler} {parts[0]} {parts[3]} x {parts[1]}"),
        (4, filler), (5, parts[0]), (6, " ".join(sorted(PASSAGE.split()))), (7, PASSAGE.replace("kappa", "KAPUTT")), (1, f"{filler} {PASSAGE} {filler}")])
    benchmark = spark.createDataFrame([(10, PASSAGE), (11, "a b"), (12, None), (10, PASSAGE), (None, PASSAGE)], "item_id long, text string")
    got = D.contaminated_pairs(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, k) for i in (1, 2, 3, 7) for k in (10, None)}
    assert {r.n_tiles for r in got if r.doc_id == 3 and r.coverage == 1} == {4}
    assert len([r for r in got if r.doc_id == 1]) == 6  # two rows of the document, three of the item
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, benchmark).collect()) == [4, 5, 6]
    # in many small blocks the pairs are the same
    pairs = sorted((r.doc_id, r.item_id or 0, r.covered_tokens) for r in got)
    found = [D.Block.of([r[0]], [r[1]]) for r in ((10, PASSAGE), (None, PASSAGE))]
    assert pairs[0][:2] == (1, 0) and len(found[0].seeds) == len(tokens(PASSAGE)) - D.MIN_MATCH + 1


def test_blocks_cover_the_benchmark(spark):
    benchmark = spark.read.parquet(f"{C.SF}/benchmark.parquet")
    ids = [i for b in D.blocks(benchmark, block_bytes=800) for i in b.ids]
    assert sorted(ids) == sorted(r.item_id for r in benchmark.collect())


def test_awkward_and_empty(spark):
    docs = C.documents(spark)
    benchmark = spark.createDataFrame([(1, C.SHARED), (2, ""), (3, "word " * 2000)], "item_id long, text string")
    got = C.rows_of(D.contaminated_pairs(docs, benchmark).select("doc_id", "item_id"))
    assert [tuple(r) for r in got] == [(4, 3), (5, 1), (5, 1), (6, 1), (None, 1)]
    clean = D.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(C.AWKWARD) - 5
    assert D.contaminated_pairs(docs.limit(0), benchmark).count() == 0
    assert D.contaminated_pairs(docs, benchmark.limit(0)).count() == 0
    assert D.drop_contaminated(docs, benchmark.limit(0)).count() == len(C.AWKWARD)


def test_scripts_without_spaces_and_wide_punctuation(spark):
    def words(t):
        w = D.tokens(pa.array([t]))
        return [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends)]

    assert words("«Été» l’an\u00a02024 – 中文，ok。カナ ไทย한국 어") == [
        "été", "l", "an", "2024", "中", "文", "ok", "カ", "ナ", "ไ", "ท", "ย", "한국", "어"]
    first, second = "第一句讲的是北京的天气非常寒冷。", "第二句说明上海的冬天比较温暖！"
    items = spark.createDataFrame([(1, first + second), (2, "東京の夏はとても暑いです。")], "item_id long, text string")
    docs = C.documents(spark, [(1, f"前言，{second}{first}后记"), (2, "東京の夏はとても暑いです、と書いた。"), (3, "完全不同的一段文字，没有任何重复内容。")])
    got = {(r.doc_id, r.item_id): r.coverage for r in D.contaminated_pairs(docs, items).collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0}
