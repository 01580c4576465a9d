"""op2 and op7: statistics against brute force, held-out accuracy, awkward tables."""

import re
import zlib
from collections import Counter

import llm_cases as C
import numpy as np
import pytest

from tagloom.llm import quality_net, quality_rules, queries

WORD = re.compile(r"[^ \t-\r]+")


def brute(t):
    t = t or ""
    words = WORD.findall(t)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.fixture(scope="module")
def quality():
    return {i: q for i, q in C.read("labels", ["doc_id", "quality"], C.SF_MEDIUM)}


def test_rules_query(spark, quality):
    texts = dict(C.read("documents", ["doc_id", "text"], C.SF_MEDIUM))
    got = queries.op2_quality_rules(spark, C.SF_MEDIUM).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        expected = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert r.base_failed == failed and (not failed or not r.kept)
    judged = [(r.kept, quality[r.doc_id]) for r in got if r.doc_id in quality and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [k for k, q in judged if q == 1]
    bad = [k for k, q in judged if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_statistics_on_odd_texts():
    import pyarrow as pa

    texts = ["", None, " ", "a\na\n\n \n \na", "x y " * 20, "é|<#", "a b c d e f g h a b c d e f g h", "\x85 \xa0 \x1c z", "l\r\nl\r\nl"]
    got = quality_rules.judge(pa.array(texts), None)
    for i, t in enumerate(texts):
        assert tuple(got[n][i] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(t), t


def test_rules_awkward_and_empty(spark):
    docs = C.documents(spark)
    got = quality_rules.quality_rules(docs, C.labels(spark)).collect()
    assert len(got) == len(C.AWKWARD)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[5].kept and not by[1].kept and not by[4].kept and by[5].probability is None
    kept = quality_rules.keep_good(docs, C.labels(spark))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [5, 5, 6]
    assert quality_rules.keep_good(docs.limit(0), C.labels(spark)).count() == 0
    # labels with nulls, repeats, unknown ids, and of one kind only
    odd = C.labels(spark, [(None, 1, 0), (5, None, 0), (5, 1, None), (5, 1, 0), (6, 1, 0), (999, 0, 1)])
    assert quality_rules.quality_rules(docs, odd).count() == len(C.AWKWARD)


def test_platt_scaling_is_calibrated():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 3, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 * z + 1)))).astype(float)
    a, b = quality_rules._platt(z, y)
    assert abs(a - 0.5) < 0.05 and abs(b - 1) < 0.1


def test_network_query(spark, quality):
    got = queries.op7_random_indexing_quality(spark, C.SF_MEDIUM).collect()
    assert len(got) == 1000
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, quality[r.doc_id]) for r in got if r.held_out and r.doc_id in quality]
    score, y = map(np.array, zip(*held))
    assert auc(score, y) > 0.9


def test_network_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{C.SF}/documents.parquet")
    labels = spark.read.parquet(f"{C.SF}/labels.parquet")
    from pyspark.sql import functions as F

    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality_net.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_net.quality_scores(docs, flipped).collect()}
    assert a == b


def test_network_awkward_and_empty(spark):
    docs = C.documents(spark)
    got = quality_net.quality_scores(docs, C.labels(spark, [(5, 1, 0), (6, 0, 0), (8, 1, 0), (9, 0, None), (None, 1, 1)])).collect()
    assert len(got) == len(C.AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert {r.score for r in quality_net.quality_scores(docs, C.labels(spark)).collect()} == {0.5}
    assert quality_net.quality_scores(docs.limit(0), C.labels(spark)).count() == 0


def test_context_vectors_by_hand():
    import pyarrow as pa

    entry, bounds = quality_net.entries(pa.array(["THE cat 12", None, "x$$$ y"]))
    assert entry[0] == quality_net.CAPITALS and entry[2] == quality_net.DIGITS and bounds.tolist() == [0, 3, 3, 6]
    batches = list(quality_net._context_task(iter([pa.RecordBatch.from_arrays([pa.array(["a b c", "a b"])], names=["text"])])))
    e, _ = quality_net.entries(pa.array(["a b c"]))
    rows = {r["entry"]: r for b in batches for r in b.to_pylist()}
    want = 2 * quality_net.INDEX[e[1]] + quality_net.INDEX[e[2]]  # b beside a twice, c two places off once
    assert [rows[e[0]][f"d{d}"] for d in range(quality_net.DIMS)] == want.astype(int).tolist() and rows[e[0]]["n"] == 2


def test_samples_are_bounded_whatever_is_repeated(spark):
    """One labelled id 30,000 times, others several times with different texts: a row an id, at most max_rows, the least text."""
    from pyspark.sql import functions as F

    from tagloom.llm import samples

    copies = spark.range(30000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    others = spark.range(600).select((F.col("id") % 200 + 2).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    labels = spark.range(1, 202).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    for bound in (100, 1000):
        rows = samples.labelled_texts(copies.unionByName(others), labels, "quality", bound).collect()
        assert len(rows) == len({r.doc_id for r in rows}) <= bound and all(r.fold and r.label == r.doc_id % 2 for r in rows)
        for r in rows:
            assert r.text == ("same" if r.doc_id == 1 else min(f"t{r.doc_id - 2 + 200 * k}" for k in range(3)))
    assert len(rows) > 130
