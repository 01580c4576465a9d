"""Plan-shape checks that guard the scale properties (no cross joins, no Python UDFs, pushdown, one shuffle)."""

import re

import pytest
from conftest import SF_SMOKE

import __spark_entry__ as E
from tagloom.operators import enrich, interest
from tagloom.session import cut_lineage
from tagloom.sources import adapters as A


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


OPTIONAL = re.compile(r"op\d+_|pipeline$")  # the training-data operators may run Python; their own tests look at them


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not OPTIONAL.match(n)))
def test_no_cross_join_or_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMOKE))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


def test_day_filter_reaches_the_scan(spark):
    plan = _plan(A.behavior(spark, SF_SMOKE, "20240102"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan
    assert "LessThan(ts,2024-01-03T00:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_merge_moves_active_users_only(spark):
    """Rows of users without rows today reach the output without an exchange, and nothing is grouped by user alone."""
    beh = A.behavior(spark, SF_SMOKE)
    state = cut_lineage(interest.replay_interest(beh, ["20240101"]), "plan-test-state")
    today = interest.daily_interest(A.behavior(spark, SF_SMOKE, "20240102"))
    text = _final(interest.merge_interest(state, today))
    assert "Window" not in text and "REPARTITION_BY_COL" not in text and "SortAggregate" not in text
    # the branch of users without rows today: from its anti join down to the state's scan
    inactive = text[text.index("LeftAnti") :].split("BroadcastQueryStage")[0]
    assert "FileScan parquet" in inactive and "Exchange" not in inactive and "Aggregate" not in inactive


def test_merge_of_a_user_with_every_product_is_spread(spark):
    """One user holds most of the state: its cells are grouped by tag, over many tasks."""
    from pyspark.sql import functions as F

    hot = spark.range(60000).select(F.lit("hot").alias("user_id"), F.lit("prod_tags").alias("family"),
                                    F.concat(F.lit("prod_"), F.col("id")).alias("tag"), F.lit(4).cast("decimal(18,2)").alias("weight"))
    rest = spark.range(20000).select(F.concat(F.lit("u"), F.col("id") % 5000).alias("user_id"), F.lit("be_tags").alias("family"),
                                     F.concat(F.lit("t"), F.floor(F.col("id") / 5000)).alias("tag"), F.lit(4).cast("decimal(18,2)").alias("weight"))
    hot_type = hot.limit(1).select("user_id", F.lit("be_tags").alias("family"), F.lit("t1").alias("tag"), "weight")
    state = cut_lineage(hot.unionByName(rest).unionByName(hot_type), "hot-state")
    today = spark.createDataFrame([("hot", "prod_tags", "prod_5", 8), ("u7", "be_tags", "t0", 1)],
                                  "user_id string, family string, tag string, new_w int")
    merged = interest.merge_interest(state, today.withColumn("new_w", F.col("new_w").cast("decimal(18,2)")))
    # no task holds all its rows: the cells come out of more than one partition
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this state is small enough for one task
    try:
        cells = merged.withColumn("task", F.spark_partition_id()).where("user_id = 'hot'")
        by_task = [r["count"] for r in cells.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(by_task) == 60001 and max(by_task) < 30000
    got = {(r.user_id, r.tag): r.weight for r in merged.where("tag IN ('prod_5', 'prod_6', 't0', 't1')").collect()}
    assert [float(got[k]) for k in (("hot", "prod_5"), ("hot", "prod_6"), ("hot", "t1"), ("u9", "t0"))] == [9, 3, 3, 4]


def test_no_single_partition_exchange_from_a_size_check(spark):
    for name in ("ip_geo_enrich", "ip_geo_json", "scan_member", "basic_tags_long"):
        assert "SinglePartition" not in _plan(E.queries()[name](spark, SF_SMOKE)), name


def test_day_partition_is_pruned(spark):
    for name in ("scan_behavior_partition", "scan_browse_partition"):
        plan = _plan(E.queries()[name](spark, SF_SMOKE))
        assert "PartitionFilters: [isnotnull(dt" in plan and "20240102" in plan


def test_range_join_is_a_hash_join(spark):
    df = enrich.ip_enrich(A.ip_probe(spark, SF_SMOKE), A.ip_ranges(spark, SF_SMOKE))
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_latest_partition_is_chosen_at_run_time(spark):
    """The day comes out of another table, and the scan of the member table reads its partition only."""
    df = E.queries()["scan_member_latest"](spark, SF_SMOKE)
    n = len(df.collect())
    text = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line and "gender" in line)
    assert "Subquery" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    rows = _scan_rows(spark, df, "gender")
    assert rows and max(rows) == n  # of three partitions of n rows each


def _scan_rows(spark, df, column):
    as_java, found = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava, []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and column in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        for child in as_java(node.children()):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found
