"""The two-phase sink: failing tasks, failing jobs, retries and re-runs leave every row once."""

import os

import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F

from tagloom.plans import cli, jobs
from tagloom.sources import adapters as A
from tagloom.sources import published as P


def rows(spark, n, tag="a", parts=4):
    df = spark.range(n, numPartitions=parts)
    return df.select(F.concat(F.lit(tag), F.col("id")).alias("ID"), F.col("id").cast("string").alias("MEMBER_ID"),
                     F.when(F.col("id") % 7 > 0, "p").alias("PROD_ID"), F.lit(1).cast("int").alias("STATUS"))


def stored(spark, path, dt=None):
    return sorted((r.dt, r.ID) for r in P.published(spark, path, dt).collect())


def files(path):
    return sorted(f for d, _, names in os.walk(os.path.join(path, "staged")) for f in names)


def test_a_date_is_published_once_however_often_it_runs(spark, tmp_dir):
    for n in (30, 40, 40):
        P.publish(rows(spark, n), tmp_dir, "20240101")
        assert stored(spark, tmp_dir) == sorted(("20240101", f"a{i}") for i in range(n))
    P.publish(rows(spark, 5, "b"), tmp_dir, "2024-01-02")
    assert len(stored(spark, tmp_dir)) == 45 and stored(spark, tmp_dir, "20240102") == [("20240102", f"b{i}") for i in range(5)]
    assert sum(r.PROD_ID is None for r in P.published(spark, tmp_dir, "20240101").collect()) == 6
    assert len(files(tmp_dir)) <= 8  # nothing of replaced runs
    P.publish(rows(spark, 0), tmp_dir, "20240102")
    assert stored(spark, tmp_dir, "20240102") == [] and len(stored(spark, tmp_dir)) == 40
    assert stored(spark, os.path.join(tmp_dir, "none")) == []


def test_a_failing_task_publishes_nothing(spark, tmp_dir):
    P.publish(rows(spark, 20), tmp_dir, "20240101")
    before = files(tmp_dir)
    bad = rows(spark, 4000, "c").withColumn("MEMBER_ID", F.when(F.col("MEMBER_ID") == "3999", F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("MEMBER_ID")))
    with pytest.raises(Exception, match="broken row"):
        P.publish(bad, tmp_dir, "20240101")
    assert stored(spark, tmp_dir) == sorted(("20240101", f"a{i}") for i in range(20)) and files(tmp_dir) == before
    P.publish(rows(spark, 50, "c"), tmp_dir, "20240101")
    assert len(stored(spark, tmp_dir)) == 50


def test_parts_of_retried_tasks_are_not_read(tmp_dir, spark):
    """Two attempts of one task stage a part each: the commit names one."""

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return self.attempt

    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"ID": "x", "MEMBER_ID": "m", "PROD_ID": "p", "STATUS": 1}],
                                       pa.schema([("ID", pa.string()), ("MEMBER_ID", pa.string()), ("PROD_ID", pa.string()), ("STATUS", pa.int32())]))
    writer = P.StagedWriter(tmp_dir, "20240101")
    with pytest.MonkeyPatch.context() as m:
        made = []
        for attempt in (1, 2):
            m.setattr(P.TaskContext, "get", classmethod(lambda cls, a=attempt: Context(a)))
            made.append(writer.write(iter([batch])))
    assert len(files(tmp_dir)) == 2
    writer.commit([made[1], None])
    assert stored(spark, tmp_dir) == [("20240101", "x")] and len(files(tmp_dir)) == 1


def test_a_commit_that_fails_leaves_the_date(spark, tmp_dir, monkeypatch):
    P.publish(rows(spark, 10), tmp_dir, "20240101")
    writer = P.StagedWriter(tmp_dir, "20240101")
    real = P._open

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "move":
                raise OSError("lost")
            return getattr(self.fs, name)

    monkeypatch.setattr(P, "_open", lambda path: (Broken(real(path)[0]), real(path)[1]))
    with pytest.raises(OSError):
        writer.commit([])
    monkeypatch.setattr(P, "_open", real)
    assert len(stored(spark, tmp_dir)) == 10
    writer.abort([])
    assert len(stored(spark, tmp_dir)) == 10


def test_push_job_publishes_and_the_command_line_views(spark, tmp_dir):
    base, out = f"{tmp_dir}/interest", f"{tmp_dir}/parts"
    for d in ("20240101", "20240102"):
        jobs.interest_job(spark, A.behavior(spark, SF_SMOKE), base, d, buckets=2)
    for _ in range(2):
        cli.main(["push", "--dt", "20240102", "--state", base, "--parts", out])
        assert P.published(spark, out, "20240102").count() == 62
    cli.main(["view", "--dt", "20240102", "--state", base, "--families", "be_tags,prod_tags", "--out", f"{tmp_dir}/view"])
    assert spark.read.parquet(f"{tmp_dir}/view").count() == 113
