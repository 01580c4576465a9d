"""Daily jobs over snapshots, the push sink, and the streaming driver; checked against in-plan replays."""

import os
import shutil
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F

from tagloom.operators import interest, push, slots
from tagloom.plans import jobs
from tagloom.sources import adapters as A
from tagloom.session import ensure_checkpoint_dir
from tagloom.sources import sinks
from tagloom.sources import snapshots as S
from tagloom.streaming import daily


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_interest_job_chain_equals_replay(spark, tmp_dir):
    beh = A.behavior(spark, SF_SMOKE)
    base = os.path.join(tmp_dir, "interest")
    for d in ["20240101", "20240102"]:
        jobs.interest_job(spark, beh, base, d)
    jobs.interest_job(spark, beh, base, "20240102")  # a re-run rewrites the same snapshot
    snap = S.read_snapshot(spark, base, "20240102", S.INTEREST_SCHEMA)
    cols = ["user_id", "family", "tag", "weight"]
    assert _rows(snap, cols) == _rows(interest.replay_interest(beh, ["20240101", "20240102"]), cols)
    assert S.snapshot_dates(spark, base) == ["20240101", "20240102"]
    prod = S.read_snapshot(spark, base, "20240102", S.INTEREST_SCHEMA, families=["prod_tags"])
    plan = prod._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "prod_tags" in plan  # family directories pruned at the scan
    out = os.path.join(tmp_dir, "push")
    assert jobs.push_job(spark, base, "20240102", parquet_path=out) == [out]
    assert spark.read.parquet(out).where(F.col("dt") == "20240102").count() == 62


def test_slots_job_and_profile_view(spark, tmp_dir):
    br = A.browse(spark, SF_SMOKE)
    st, sm = os.path.join(tmp_dir, "slots"), os.path.join(tmp_dir, "summary")
    cells = os.path.join(tmp_dir, "cells")
    for d in ["20240101", "20240102"]:
        jobs.slots_job(spark, br, st, sm, d)
    two = slots.merge_slots(slots.daily_slots(A.browse(spark, SF_SMOKE, "20240101")),
                            slots.daily_slots(A.browse(spark, SF_SMOKE, "20240102")))
    assert _rows(S.read_snapshot(spark, st, "20240102", S.SLOT_SCHEMA), ["user_id", "slot", "n"]) == \
        _rows(two, ["user_id", "slot", "n"])
    summ = {r.user_id: r.summary for r in S.read_snapshot(spark, sm, "20240102", S.SUMMARY_SCHEMA).collect()}
    per_day = slots.daily_slots(br.where(F.col("dt").isin("20240101", "20240102")), by_day=True)
    want = {r.user_id: r.summary for r in slots.history_summary(per_day).collect()}
    assert summ == want
    jobs.basic_tags_job(spark, A.member(spark, SF_SMOKE, "20240102"), cells, "20240102", as_of="2018-07-15")
    part = ("time_tags", "user_tags")
    view = jobs.profile_view(spark, "20240102", None, st, sm, cells, families=part)
    fams = {r.family for r in view.select("family").distinct().collect()}
    assert fams == {"time_tags", "user_tags"}
    ib = os.path.join(tmp_dir, "interest")
    for d in ["20240101", "20240102"]:
        jobs.interest_job(spark, A.behavior(spark, SF_SMOKE), ib, d)
    full = jobs.profile_view(spark, "20240102", ib, st, sm, cells)
    assert {r.family for r in full.select("family").distinct().collect()} == {"time_tags", "user_tags", "be_tags",
                                                                              "prod_tags"}
    assert full.where(F.col("family").isin("be_tags", "prod_tags")).count() == 113
    assert view.where((F.col("family") == "user_tags") & (F.col("tag") == "time_tags")).count() == len(summ)


def test_stream_runs_daily_jobs_in_order(spark, tmp_dir):
    src = os.path.join(tmp_dir, "behavior")
    base = os.path.join(tmp_dir, "state")
    ckpt = os.path.join(tmp_dir, "ckpt")
    beh = A.behavior(spark, SF_SMOKE)
    daily.write_daily_table(beh, src, ["20240101", "20240102"])
    daily.interest_stream(spark, src, base, ckpt).awaitTermination()
    cols = ["user_id", "family", "tag", "weight"]
    got = S.read_snapshot(spark, base, "20240102", S.INTEREST_SCHEMA)
    assert len(got.collect()) == 113
    # a later day, then late files for day 1: both re-run what depends on them
    daily.write_daily_table(beh, src, ["20240103"])
    daily.interest_stream(spark, src, base, ckpt).awaitTermination()
    days = ["20240101", "20240102", "20240103"]
    assert _rows(S.read_snapshot(spark, base, "20240103", S.INTEREST_SCHEMA), cols) == \
        _rows(interest.replay_interest(beh, days), cols)
    daily.write_daily_table(beh, src, ["20240101"])  # late files: day 1 now holds every row twice
    daily.interest_stream(spark, src, base, ckpt).awaitTermination()
    table = spark.read.schema(daily.BEHAVIOR_SCHEMA).parquet(src)
    want = _rows(interest.replay_interest(table, days), cols)
    assert want != _rows(interest.replay_interest(beh, days), cols)
    assert _rows(S.read_snapshot(spark, base, "20240103", S.INTEREST_SCHEMA), cols) == want


def test_profile_view_without_a_snapshot_is_an_error(spark, tmp_dir):
    st, sm = os.path.join(tmp_dir, "slots"), os.path.join(tmp_dir, "summary")
    jobs.slots_job(spark, A.browse(spark, SF_SMOKE), st, sm, "20240101")
    assert jobs.profile_view(spark, "20240101", slots_base=st, families=("time_tags",)).count() > 0
    for bad in ({"slots_base": st}, {"slots_base": st, "interest_base": os.path.join(tmp_dir, "none")}):
        with pytest.raises((ValueError, FileNotFoundError)):
            jobs.profile_view(spark, "20240101", **bad)
    with pytest.raises(FileNotFoundError):  # another date
        jobs.profile_view(spark, "20240102", slots_base=st, families=("time_tags",))


def test_missing_summary_of_the_day_before_is_an_error(spark, tmp_dir):
    st, sm = os.path.join(tmp_dir, "slots"), os.path.join(tmp_dir, "summary")
    br = A.browse(spark, SF_SMOKE)
    jobs.slots_job(spark, br, st, sm, "20240101")
    shutil.rmtree(os.path.join(sm, "dt=20240101"))
    with pytest.raises(FileNotFoundError, match="20240101"):
        jobs.slots_job(spark, br, st, sm, "20240102")
    jobs.slots_job(spark, br, st, sm, "20240101")
    jobs.slots_job(spark, br, st, sm, "20240102")
    per_day = slots.daily_slots(br.where(F.col("dt").isin("20240101", "20240102")), by_day=True)
    assert S.read_snapshot(spark, sm, "20240102", S.SUMMARY_SCHEMA).count() == slots.history_summary(per_day).count()


def test_a_failed_commit_leaves_the_old_snapshot(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "cells")
    df = spark.createDataFrame([("u", "a", "1", "f")], S.CELL_SCHEMA)
    S.write_snapshot(df, base, "20240101")

    def fail(*a):
        raise OSError("lost")

    for step, value in (("_commit", "1"), ("_delete_older", "2")):
        with monkeypatch.context() as m:
            m.setattr(S, step, fail)
            with pytest.raises(OSError):
                S.write_snapshot(df.withColumn("value", F.lit("2")), base, "20240101")
        assert [r.value for r in S.read_snapshot(spark, base, "20240101", S.CELL_SCHEMA).collect()] == [value]
    S.write_snapshot(df.withColumn("value", F.lit("3")), base, "20240101")
    assert [r.value for r in S.read_snapshot(spark, base, "20240101", S.CELL_SCHEMA).collect()] == ["3"]
    assert len([x for x in os.listdir(os.path.join(base, "dt=20240101")) if x.startswith("v=")]) == 1
    # a date whose first write was never committed has no snapshot
    with monkeypatch.context() as m:
        m.setattr(S, "_commit", fail)
        with pytest.raises(OSError):
            S.write_snapshot(df, base, "20240102")
    assert S.snapshot_dates(spark, base) == ["20240101"]


def test_snapshot_files_are_sorted_by_user(spark, tmp_dir):
    base = os.path.join(tmp_dir, "cells")
    rows = [(f"u{i * 7919 % 500}", f"t{i}", "1", f"f{i % 3}") for i in range(3000)]
    S.write_snapshot(spark.createDataFrame(rows, S.CELL_SCHEMA).repartition(2), base, "20240101")
    files = [os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")]
    assert len(files) >= 3
    for f in files:
        users = pq.ParquetFile(f).read(columns=["user_id"])["user_id"].to_pylist()
        assert users == sorted(users)


def _tables(spark):
    root = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_push_job_leaves_no_intermediate_tables(spark, tmp_dir):
    base = os.path.join(tmp_dir, "interest")
    jobs.interest_job(spark, A.behavior(spark, SF_SMOKE), base, "20240101", keep_null_product=True)
    jobs.interest_job(spark, A.behavior(spark, SF_SMOKE), base, "20240102", decay_inactive=True)
    before = _tables(spark)
    jobs.push_job(spark, base, "20240102", parquet_path=os.path.join(tmp_dir, "push"), exclude_seen=True, id_mode="random")
    assert _tables(spark) == before
    assert spark.read.parquet(os.path.join(tmp_dir, "push")).where("length(ID) <> 32").count() == 0
    with pytest.raises(ValueError):
        jobs.push_job(spark, base, "20240102")


class StubWriter:
    """Records what a DataFrameWriter is told."""

    def __init__(self):
        self.said = {}

    def mode(self, mode):
        self.said["mode"] = mode
        return self

    def option(self, name, value):
        self.said[name] = value
        return self

    def jdbc(self, url, table, properties):
        self.said |= {"url": url, "table": table, "properties": properties}


def test_jdbc_options(tmp_dir):
    rows = SimpleNamespace(write=StubWriter())
    sinks.write_push_jdbc(rows, "jdbc:x", "PUSH", {"user": "u"}, batchsize=50, num_partitions=4)
    assert rows.write.said == {"mode": "append", "batchsize": "50", "numPartitions": "4", "url": "jdbc:x", "table": "PUSH",
                               "properties": {"user": "u"}}


def test_cli_passes_every_option(spark, monkeypatch):
    from tagloom.plans import cli

    said = {}
    for name in ("interest_job", "slots_job", "basic_tags_job", "push_job"):
        monkeypatch.setattr(jobs, name, lambda *a, _n=name, **kw: said.update({_n: kw}) or ["x"])
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path: path)
    cli.main("interest --dt 20240101 --input i --state s --expire keep_stale --decay-inactive --keep-null-product".split())
    cli.main("slots --dt 20240101 --input i --state s --summary m --summary-slots all".split())
    cli.main("basic --dt 20240101 --input i --state s --rule reference --as-of 2018-07-15".split())
    cli.main("push --dt 20240101 --state s --jdbc-url jdbc:x --jdbc-table T --jdbc-property user=u --jdbc-property password=a=b "
             "--exclude-seen --id-mode random --seed min".split())
    assert said["interest_job"] == {"expire": "keep_stale", "decay_inactive": True, "keep_null_product": True}
    assert said["slots_job"] == {"summary": "all"} and said["basic_tags_job"] == {"as_of": "2018-07-15", "rule": "reference"}
    assert said["push_job"] == {"seed": "min", "exclude_seen": True, "id_mode": "random", "parquet_path": None, "jdbc": {
        "url": "jdbc:x", "table": "T", "properties": {"user": "u", "password": "a=b"}}}


def test_push_lists_bounded(spark):
    st = interest.replay_interest(A.behavior(spark, SF_SMOKE), ["20240101", "20240102"])
    lists = push.push_lists(st)
    assert lists.where(F.size(F.split("PROD_IDS", ",")) > 6).count() == 0


def test_slots_stream_matches_closed_form(spark, tmp_dir):
    src, st, sm = (os.path.join(tmp_dir, x) for x in ("browse", "slots", "summary"))
    br = A.browse(spark, SF_SMOKE)
    days = ["20240101", "20240102", "20240103"]
    daily.write_daily_table(br, src, days)
    daily.slots_stream(spark, src, st, sm, os.path.join(tmp_dir, "ckpt")).awaitTermination()
    per_day = slots.daily_slots(br.where(F.col("dt").isin(*days)), by_day=True)
    totals = per_day.groupBy("user_id", "slot").agg(F.sum("n").cast("bigint").alias("n"))
    assert _rows(S.read_snapshot(spark, st, days[-1], S.SLOT_SCHEMA), ["user_id", "slot", "n"]) == \
        _rows(totals, ["user_id", "slot", "n"])
    got = {r.user_id: r.summary for r in S.read_snapshot(spark, sm, days[-1], S.SUMMARY_SCHEMA).collect()}
    assert got == {r.user_id: r.summary for r in slots.history_summary(per_day).collect()}


def test_cli_interest_and_push(spark, tmp_dir):
    from tagloom.plans import cli

    src, state, out = (os.path.join(tmp_dir, x) for x in ("behavior", "state", "push"))
    daily.write_daily_table(A.behavior(spark, SF_SMOKE), src, ["20240101", "20240102"])
    cli.main(["interest", "--dt", "20240101", "--input", src, "--state", state])
    cli.main(["interest", "--dt", "2024-01-02", "--input", src, "--state", state])
    cli.main(["push", "--dt", "20240102", "--state", state, "--out", out])
    assert spark.read.parquet(out).count() == 62


def test_scratch_scope_deletes_intermediate_tables(spark):
    from tagloom.session import cut_lineage, scratch_scope

    with scratch_scope(spark):
        t = cut_lineage(spark.range(10), "scope-test")
        path = t._tagloom_path
        assert t.count() == 10
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not fs.exists(fs_path)


def test_parquet_push_sink_rerun_replaces_the_date(spark, tmp_dir):
    from tagloom.sources.sinks import write_push_parquet

    st = interest.replay_interest(A.behavior(spark, SF_SMOKE), ["20240101", "20240102"])
    rows = push.push_rows(st, "20240102")
    out = os.path.join(tmp_dir, "push")
    write_push_parquet(rows, out, "20240102")
    write_push_parquet(rows, out, "20240102")  # re-run of the same date: replaced, not appended
    write_push_parquet(push.push_rows(st, "20240103"), out, "20240103")
    got = spark.read.parquet(out)
    assert got.where(F.col("dt") == "20240102").count() == 62
    assert got.where(F.col("dt") == "20240103").count() == 62
    assert got.select("ID").distinct().count() == 124  # ids differ by run date
