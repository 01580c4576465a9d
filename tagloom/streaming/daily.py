"""Structured Streaming driver for the daily jobs.

A file stream over a dt-partitioned daily table (behaviour, browse, member)
tells which dates received new files. For each micro-batch, ``foreachBatch``
collects that set of dates (bounded by the calendar, not by the data) and runs
the batch job for every affected date in order, reading the *complete* day
partition from the table, not the micro-batch rows. Because snapshot n is a
function of snapshot n-1 and the whole of day n, a replayed micro-batch or a day
split over several batches gives the same snapshots; files that arrive late for
an earlier date re-run that date and every later date already processed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import jobs
from ..sources import snapshots as S
from ..sources.adapters import dt_key

BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type_id", T.StringType()),
    T.StructField("prod_id", T.StringType()), T.StructField("behavior_id", T.StringType()),
    T.StructField("dt", T.StringType())])
BROWSE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("browse_time", T.StringType()),
    T.StructField("dt", T.StringType())])


def run_on_new_days(spark: SparkSession, source_path: str, schema: T.StructType,
                    job: Callable[[DataFrame, str], object], state_base: str, checkpoint_location: str,
                    available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; ``job(table, dt)`` is the batch job for one date."""
    reader = spark.readStream.schema(schema).option("basePath", source_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        new_days = sorted(r.dt for r in batch.select("dt").distinct().collect())
        if not new_days:
            return
        done = [d for d in S.snapshot_dates(spark, state_base) if d > dt_key(new_days[0])]
        table = spark.read.schema(schema).option("basePath", source_path).parquet(source_path)
        for d in sorted(set(new_days) | set(done)):
            job(table, d)

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def interest_stream(spark: SparkSession, behavior_path: str, state_base: str, checkpoint_location: str,
                    expire: str = "drop", **kw):
    return run_on_new_days(
        spark, behavior_path, BEHAVIOR_SCHEMA,
        lambda table, d: jobs.interest_job(spark, table, state_base, d, expire=expire),
        state_base, checkpoint_location, **kw)


def slots_stream(spark: SparkSession, browse_path: str, state_base: str, summary_base: str,
                 checkpoint_location: str, **kw):
    return run_on_new_days(
        spark, browse_path, BROWSE_SCHEMA,
        lambda table, d: jobs.slots_job(spark, table, state_base, summary_base, d),
        state_base, checkpoint_location, **kw)


def write_daily_table(df: DataFrame, path: str, days: list[str] | None = None) -> None:
    """Append day partitions of a daily table (used to feed the stream in tests and backfills)."""
    if days:
        df = df.where(F.col("dt").isin(*[dt_key(d) for d in days]))
    df.write.mode("append").partitionBy("dt").parquet(path)
