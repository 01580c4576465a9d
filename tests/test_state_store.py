"""Change-only state: what is written, moved and read; chains, tombstones, compaction, re-runs and old versions."""

import os
import random
import re
from decimal import Decimal

import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F

from tagloom.operators import interest
from tagloom.plans import jobs
from tagloom.session import cut_lineage
from tagloom.sources import adapters as A
from tagloom.sources import snapshots as S
from tagloom.sources import state as ST

DAYS = [f"202401{d:02d}" for d in range(1, 7)]


def rows(df, cols=("user_id", "family", "tag", "weight")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def cells(spark, data):
    return spark.createDataFrame([(u, t, Decimal(w), f) for u, f, t, w in data], S.INTEREST_SCHEMA)


def changes(spark, data, gone=()):
    new = cells(spark, data).withColumn("deleted", F.lit(False))
    old = spark.createDataFrame([(u, t, None, f, True) for u, f, t in gone], new.schema)
    return new.unionByName(old)


def test_a_day_writes_what_it_changes(spark, tmp_dir):
    """Every day's delta holds the cells that differ from the day before, and the chain reads as the replay."""
    beh = A.behavior(spark, SF_SMOKE)
    store = S.interest_store(spark, tmp_dir, buckets=4, compact_share=100.0)
    before = {}
    for n, d in enumerate(DAYS, 1):
        jobs.interest_job(spark, beh, tmp_dir, d, buckets=4, compact_share=100.0)
        want = rows(interest.replay_interest(beh, DAYS[:n]))
        assert rows(S.read_snapshot(spark, tmp_dir, d, S.INTEREST_SCHEMA)) == want
        after = {r[:3]: r[3] for r in want}
        changed = {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
        assert store.version(d).rows == len(changed)
        before = after
    assert [v.kind for v in store.chain(DAYS[-1])] == ["delta"] * 5 + ["base"]


def test_a_hot_day_becomes_a_base(spark, tmp_dir):
    store = S.interest_store(spark, tmp_dir, buckets=2, compact_share=0.5, most_deltas=3)
    store.commit("20240101", None, changes(spark, [(f"u{i}", "be_tags", "a", "1.00") for i in range(20)]))
    kinds = []
    for d, n in (("20240102", 4), ("20240103", 4), ("20240104", 4), ("20240105", 1), ("20240106", 1), ("20240107", 1), ("20240108", 1)):
        kinds.append(store.commit(d, str(int(d) - 1), changes(spark, [(f"u{i}", "be_tags", "a", f"{d[-1]}.00") for i in range(n)])).kind)
    assert kinds == ["delta", "delta", "base", "delta", "delta", "delta", "base"]  # by share, then by number
    got = {r.user_id: str(r.weight) for r in store.read("20240108").collect()}
    assert got == {f"u{i}": "8.00" if i < 1 else "4.00" if i < 4 else "1.00" for i in range(20)}
    assert len([n for n in os.listdir(f"{tmp_dir}/dt=20240104") if n.startswith("v=")]) == 1  # the delta that the base replaced is gone


def test_ended_null_and_blank_keys(spark, tmp_dir):
    store = S.interest_store(spark, tmp_dir, buckets=4, compact_share=100.0)
    first = [(None, "be_tags", "a", "1.00"), ("", "be_tags", "a", "2.00"), ("x", "be_tags", "a", "3.00"), ("x", "prod_tags", "p", "4.00")]
    store.commit("20240101", None, changes(spark, first))
    store.commit("20240102", "20240101", changes(spark, [(None, "be_tags", "a", "5.00")], [("x", "be_tags", "a")]))
    store.commit("20240103", "20240102", changes(spark, [("x", "be_tags", "a", "6.00"), ("é'\\", "prod_tags", "p", "7.00")], [("", "be_tags", "a")]))
    store.commit("20240104", "20240103", changes(spark, []))  # an empty day
    assert rows(store.read("20240102")) == rows(cells(spark, [(None, "be_tags", "a", "5.00"), first[1], first[3]]))
    want = rows(cells(spark, [(None, "be_tags", "a", "5.00"), ("x", "be_tags", "a", "6.00"), first[3], ("é'\\", "prod_tags", "p", "7.00")]))
    assert rows(store.read("20240104")) == rows(S.read_snapshot(spark, tmp_dir, "20240104", S.INTEREST_SCHEMA)) == want
    assert rows(store.read("20240104", families=["prod_tags"])) == [r for r in want if r[1] == "prod_tags"]
    some = spark.createDataFrame([(None,), ("x",), ("",), ("nobody",), ("x",)], "user_id string")
    assert rows(store.cells_of("20240104", some)) == [r for r in want if r[0] in (None, "x")]
    assert store.cells_of("20240104", some.limit(0)).collect() == [] and store.cells_of(None, some).collect() == []


def test_re_runs_keep_what_readers_and_later_days_need(spark, tmp_dir):
    store = S.interest_store(spark, tmp_dir, buckets=2, compact_share=100.0)

    def one(w):
        return changes(spark, [("u", "be_tags", "a", w), ("v", "be_tags", "a", "9.00")])

    store.commit("20240101", None, one("1.00"))
    store.commit("20240102", "20240101", changes(spark, [("w", "be_tags", "a", "3.00")]))
    planned = store.read("20240101")
    for w in ("2.00", "3.00", "4.00"):
        store.commit("20240101", None, one(w))
        if w == "2.00":
            assert len(planned.collect()) == 2  # a job that planned on the replaced version still reads it
    names = sorted(n for n in os.listdir(f"{tmp_dir}/dt=20240101") if n.startswith("v="))
    assert [int(n[2:22]) for n in names] == [1, 3, 4]  # the first is what the second day builds on, the third was just replaced
    assert {str(r.weight) for r in store.read("20240102").collect()} == {"1.00", "9.00", "3.00"}
    store.commit("20240102", "20240101", changes(spark, [("w", "be_tags", "a", "5.00")]))
    assert {str(r.weight) for r in store.read("20240102").collect()} == {"4.00", "9.00", "5.00"}
    store.commit("20240102", "20240101", changes(spark, []))
    store.commit("20240102", "20240101", changes(spark, []))
    store.commit("20240101", None, one("6.00"))
    assert [int(n[2:22]) for n in sorted(os.listdir(f"{tmp_dir}/dt=20240101")) if n.startswith("v=")] == [4, 5]


@pytest.mark.parametrize("step", ["_put_in_force", "_clean"])
def test_a_failed_commit_leaves_a_whole_state(spark, tmp_dir, monkeypatch, step):
    store = S.interest_store(spark, tmp_dir, buckets=2)
    store.commit("20240101", None, changes(spark, [("u", "be_tags", "a", "1.00")]))

    def fail(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ST.StateStore, step, fail)
        with pytest.raises(OSError):
            store.commit("20240101", None, changes(spark, [("u", "be_tags", "a", "2.00")]))
        with pytest.raises(OSError):
            store.commit("20240102", "20240101", changes(spark, [("u", "be_tags", "a", "3.00")]))
    assert {str(r.weight) for r in store.read("20240101").collect()} == {"1.00" if step == "_put_in_force" else "2.00"}
    assert store.dates() == ["20240101"] + (["20240102"] if step == "_clean" else [])
    store.commit("20240102", "20240101", changes(spark, [("u", "be_tags", "a", "4.00")]))
    assert [str(r.weight) for r in store.read("20240102").collect()] == ["4.00"]


def many(spark, n=4000, buckets=8):
    data = spark.range(n).select((F.concat(F.lit("u"), F.col("id") % 500)).alias("user_id"), F.concat(F.lit("t"), F.col("id")).alias("tag"),
                                 F.lit(2).cast("decimal(18,2)").alias("weight"), F.when(F.col("id") % 2 == 0, "be_tags").otherwise("prod_tags").alias("family"))
    return data.withColumn("deleted", F.lit(False))


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_state_is_scanned_once_and_not_moved(spark, tmp_dir, monkeypatch):
    """Without broadcasts: each version's files are joined where they lie, once; only the users are exchanged."""
    store = S.interest_store(spark, tmp_dir, buckets=8, compact_share=100.0)
    store.commit("20240101", None, many(spark))
    store.commit("20240102", "20240101", changes(spark, [("u1", "be_tags", "new", "1.00"), ("u2", "prod_tags", "new", "1.00")]))
    users = spark.range(250).select(F.concat(F.lit("u"), F.col("id") * 2).alias("user_id"))
    plans = []

    def spy(df, name, *a):
        out = cut_lineage(df, name, *a)
        if name == "state-cells":
            df.collect()
            plans.append(final_plan(df))
        return out

    monkeypatch.setattr(ST, "cut_lineage", spy)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = store.cells_of("20240102", users)
        assert got.count() == 4000 // 2 + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan, = plans
    scans = [line for line in plan.splitlines() if "FileScan" in line and "weight" in line]
    assert len(scans) == 4 and all("Bucketed: true" in s for s in scans)  # base and delta, two families each: once
    for side in re.findall(r"LeftSemi.*?(?=LeftSemi|\Z)", plan, re.S):
        state = side[: side.index("weight", side.index("FileScan"))]
        assert "Exchange" not in state and "ShuffleQueryStage" not in state


def test_few_users_read_few_files(spark, tmp_dir, monkeypatch):
    """One user's buckets are read, and no others."""
    store = S.interest_store(spark, tmp_dir, buckets=16, spread=2)
    store.commit("20240101", None, many(spark))
    some = spark.createDataFrame([("u7",)], "user_id string")
    seen = []

    def spy(df, name, *a):
        if name == "state-cells":
            df.collect()
            seen.append((final_plan(df), sum(scanned_rows(spark, df))))
        return cut_lineage(df, name, *a)

    monkeypatch.setattr(ST, "cut_lineage", spy)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = store.cells_of("20240101", some)
        assert got.count() == 8 and {r.user_id for r in got.collect()} == {"u7"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    (plan, read), = seen
    picked = [int(x) for x in re.findall(r"SelectedBucketsCount: (\d+) out of 16", plan)]
    assert len(picked) == 2 and all(p <= 2 for p in picked)  # at most ``spread`` buckets of sixteen, in each family
    assert 8 <= read < 4000 / 4


def scanned_rows(spark, df) -> list[int]:
    """Rows that came out of each scan of the state in a plan that has run."""
    as_java, found = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava, []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and "weight" in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        for child in as_java(node.children()):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_user_with_most_cells_is_spread(spark, tmp_dir):
    store = S.interest_store(spark, tmp_dir, buckets=16)
    hot = spark.range(8000).select(F.lit("hot").alias("user_id"), F.concat(F.lit("t"), F.col("id")).alias("tag"), F.lit(2).cast("decimal(18,2)").alias("weight"),
                                   F.lit("prod_tags").alias("family"), F.lit(False).alias("deleted"))
    store.commit("20240101", None, hot)
    per = [r["count"] for r in store._rows(store.version("20240101")).groupBy("deal").count().collect()]
    assert len(per) == 8 and max(per) < 8000 / 4
    assert store.cells_of("20240101", spark.createDataFrame([("hot",)], "user_id string")).count() == 8000


def test_random_days_equal_a_model(spark, tmp_dir):
    rng, store, model = random.Random(6), S.interest_store(spark, tmp_dir, buckets=3, compact_share=0.8, most_deltas=4), {}
    kinds = set()
    for n, d in enumerate([f"202402{x:02d}" for x in range(1, 9)]):
        keys = [(f"u{rng.randrange(6)}", rng.choice(["be_tags", "prod_tags"]), f"t{rng.randrange(4)}") for _ in range(30 if not n else 6)]
        new = {k: f"{rng.randrange(1, 900) / 100:.2f}" for k in keys}
        gone = [k for k in rng.sample(sorted(model), min(len(model), 3)) if k not in new]
        model = {k: v for k, v in model.items() if k not in gone} | new
        kinds.add(store.commit(d, None if not n else f"202402{n:02d}", changes(spark, [(*k, v) for k, v in new.items()], gone)).kind)
        assert rows(store.read(d)) == rows(cells(spark, [(*k, v) for k, v in model.items()]))
        users = spark.createDataFrame([("u1",), ("u4",)], "user_id string")
        assert rows(store.cells_of(d, users)) == [r for r in rows(store.read(d)) if r[0] in ("u1", "u4")]
    assert kinds == {"base", "delta"}


def test_basic_tags_write_changed_values_only(spark, tmp_dir):
    for d, as_of in (("20240101", "2018-01-15"), ("20240102", "2018-07-15")):
        jobs.basic_tags_job(spark, A.member(spark, SF_SMOKE, d), tmp_dir, d, as_of=as_of, buckets=2, compact_share=100.0)
    store = S.cell_store(spark, tmp_dir)
    first, second = ({(r.user_id, r.tag): r.value for r in store.read(d).collect()} for d in ("20240101", "20240102"))
    assert 0 < store.version("20240102").rows == sum(first[k] != second[k] for k in second) < len(second) / 10


def test_a_job_that_cannot_write_its_summary_writes_nothing(spark, tmp_dir):
    import shutil

    st, sm = f"{tmp_dir}/slots", f"{tmp_dir}/summary"
    br = A.browse(spark, SF_SMOKE)
    jobs.slots_job(spark, br, st, sm, "20240101")
    shutil.rmtree(f"{sm}/dt=20240101")
    with pytest.raises(FileNotFoundError, match="20240101"):
        jobs.slots_job(spark, br, st, sm, "20240102")
    assert S.slot_store(spark, st).dates() == ["20240101"]
