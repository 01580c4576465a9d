"""The pipeline: every stage against a brute-force version of it, and awkward documents through all stages."""

import re

import corpus_pipeline
import llm_cases as C
import pytest
from test_llm_near_duplicates import brute as brute_groups
from test_llm_pii import brute as brute_pii
from test_llm_tokens import check_packing

from tagloom.llm import decontaminate, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, sf):
    """Each stage's result, written and read again."""
    from tagloom.session import cut_lineage

    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf), f"test-{name}")
        yield name, docs


def masked(text):
    spans = [(a, b, k) for k, x in zip(("EMAIL", "IP", "CARD", "PHONE"), brute_pii(text)) for a, b in x]
    spans += [(*m.span(1), "SECRET") for m in re.finditer(r'token = "([0-9a-f]{40})"', text)]
    for a, b, k in sorted(spans, reverse=True):
        text = f"{text[:a]}[{k}]{text[b:]}"
    return text


@pytest.fixture(scope="module")
def results(spark):
    return dict(stages(spark, spark.read.parquet(f"{C.SF}/documents.parquet"), C.SF))


def test_stage_names_and_columns(results):
    assert list(results) == ["quality_rules", "near_dedup", "decontamination", "pii", "packing"]
    for name in list(results)[:-1]:
        assert results[name].columns == COLUMNS


def test_stages_equal_brute_force(spark, results):
    texts = dict(C.read("documents", ["doc_id", "text"]))
    kept = {r.doc_id for r in queries.op2_quality_rules(spark, C.SF).collect() if r.kept}
    assert {r.doc_id for r in results["quality_rules"].collect()} == kept
    groups = brute_groups([(i, texts[i]) for i in sorted(kept)])
    single = {i for i, (_, c) in groups.items() if i == c}
    assert {r.doc_id for r in results["near_dedup"].collect()} == single
    items = [re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", t.lower()).strip() for _, t in C.read("benchmark", ["item_id", "text"])]
    flat = {i: " " + re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", texts[i].lower()) + " " for i in single}
    leaks = {i for i, t in flat.items() if any(f" {x} " in t for x in items)}  # all leaks here are whole passages
    clean = single - leaks
    assert leaks and {r.doc_id for r in results["decontamination"].collect()} == clean
    rows = results["pii"].collect()
    assert {r.doc_id: r.text for r in rows} == {i: masked(texts[i]) for i in clean}
    assert all(r.n_chars == len(r.text) for r in rows)
    used, bound = check_packing(results["packing"].collect(), {r.doc_id: r.text for r in rows})
    assert used <= bound + 1


def test_run_gives_the_last_stage(spark, results):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert C.rows_of(corpus_pipeline.run(spark, C.SF).select(key)) == C.rows_of(results["packing"].select(key))


def test_awkward_documents_through_every_stage(spark):
    extra = [(20 + i, f"{C.SHARED} number {i} {'abcdefgh'[i]}{i} " + " ".join(f"u{i}x{k}" for k in range(30))) for i in range(5)]
    docs = C.documents(spark, C.AWKWARD + extra)
    for name, out in stages(spark, docs, C.SF):
        if name != "packing":
            assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {20, 21, 22, 23, 24}
    for name, out in stages(spark, docs.limit(0), C.SF):
        assert out.count() == 0


def test_each_stage_takes_null_and_repeated_rows_alone(spark):
    docs = C.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, C.SF).count() <= len(C.AWKWARD) + 200
    benchmark = spark.read.parquet(f"{C.SF}/benchmark.parquet")
    assert decontaminate.drop_contaminated(docs, benchmark).count() == len(C.AWKWARD)
