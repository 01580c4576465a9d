"""Full snapshots of a date, and the readers of all that is kept by date.

The daily jobs keep their state as bases and deltas (``state.py``); ``read_snapshot`` and the listings below take
both forms. A full snapshot is one parquet directory per partition date, partitioned by family:

``<base>/dt=<yyyyMMdd>/v=<version>/family=<name>/part-*.parquet``, and
``<base>/dt=<yyyyMMdd>/_current-<version>``, an empty file that puts a version in force.
Day n's job reads the snapshot of day n-1 and writes day n; a re-run of a date
writes a new version of that date only. A version counts from the moment its commit
file exists (one create, the newest counts), and older versions are deleted after
that, so a job that fails at any point leaves the date as it was
or as it is to be, and readers never see part of a write.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .adapters import dt_key
from .state import META, StateStore

INTEREST_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("weight", T.DecimalType(18, 2)), T.StructField("family", T.StringType())])
SLOT_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("slot", T.StringType()),
    T.StructField("n", T.LongType())])
SUMMARY_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("summary", T.StringType())])
CELL_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("tag", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("family", T.StringType())])


def interest_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, base, INTEREST_SCHEMA, ("user_id", "family", "tag"), **layout)


def slot_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, base, SLOT_SCHEMA, ("user_id", "slot"), **{"spread": 1} | layout)


def summary_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, base, SUMMARY_SCHEMA, ("user_id",), **{"spread": 1} | layout)


def cell_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, base, CELL_SCHEMA, ("user_id", "family", "tag"), **{"spread": 1} | layout)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def snapshot_path(base: str, dt: str) -> str:
    return f"{base.rstrip('/')}/dt={dt_key(dt)}"


def _current(spark: SparkSession, base: str, dt: str) -> str | None:
    """The version of ``dt`` in force, or None: the newest commit file names it."""
    fs, p = _fs(spark, snapshot_path(base, dt))
    if not fs.exists(p):
        return None
    commits = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith("_current-"))
    return commits[-1].removeprefix("_current-") if commits else None


def committed_path(spark: SparkSession, base: str, dt: str) -> str:
    version = _current(spark, base, dt)
    if version is None:
        raise FileNotFoundError(f"no committed snapshot of {dt_key(dt)} in {base}")
    return f"{snapshot_path(base, dt)}/v={version}"


def _write_version(df: DataFrame, base: str, dt: str, partition_by: tuple[str, ...], sort_by: tuple[str, ...]) -> str:
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # versions sort by time of writing
    # partition columns first: the writer then keeps the order inside each file
    order = [c for c in (*partition_by, *sort_by) if c in df.columns]
    w = df.sortWithinPartitions(*order).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{snapshot_path(base, dt)}/v={version}")
    return version


def _commit(spark: SparkSession, base: str, dt: str, version: str) -> None:
    fs, p = _fs(spark, f"{snapshot_path(base, dt)}/_current-{version}")
    fs.create(p, False).close()


def _delete_older(spark: SparkSession, base: str, dt: str, version: str) -> None:
    fs, p = _fs(spark, snapshot_path(base, dt))
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        own = name.removeprefix("v=").removeprefix("_current-")
        if name.startswith(("v=", "_current-")) and own < version:
            fs.delete(st.getPath(), True)


def write_snapshot(df: DataFrame, base: str, dt: str, partition_by: tuple[str, ...] = ("family",),
                   sort_by: tuple[str, ...] = ("user_id",)) -> str:
    """Write ``df`` as the snapshot of ``dt`` (replacing an earlier run of the same date)."""
    spark = df.sparkSession
    version = _write_version(df, base, dt, partition_by, sort_by)
    _commit(spark, base, dt, version)
    _delete_older(spark, base, dt, version)
    return snapshot_path(base, dt)


def read_snapshot(spark: SparkSession, base: str, dt: str, schema: T.StructType,
                  families: list[str] | None = None) -> DataFrame:
    """State of ``dt`` with an explicit schema (no inference of partition types);
    a family filter prunes the other family directories."""
    path = committed_path(spark, base, dt)
    fs, meta = _fs(spark, f"{path}/{META}")
    if fs.exists(meta):
        keys = tuple(c for c in ("user_id", "family", "tag", "slot") if c in schema.names)
        return StateStore(spark, base, schema, keys).read(dt, families)
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if families:
        df = df.where(F.col("family").isin(*families))
    return df


def snapshot_dates(spark: SparkSession, base: str) -> list[str]:
    """Dates that have a committed snapshot (a directory listing, bounded by the calendar)."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("dt=") and _current(spark, base, name[3:]):
            out.append(name[3:])
    return sorted(out)


def latest_before(spark: SparkSession, base: str, dt: str) -> str | None:
    earlier = [d for d in snapshot_dates(spark, base) if d < dt_key(dt)]
    return earlier[-1] if earlier else None
