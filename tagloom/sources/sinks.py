"""Push-row sinks: a JDBC table (append, batched) or a parquet table partitioned by run date.

Connection details are arguments; nothing is hard-coded. The JDBC writer opens
one connection per task and inserts in batches (``batchsize``); the number of
concurrent connections is capped with ``num_partitions``. JDBC appends are not
atomic: a task or job that is run again inserts its rows again. Give the target
table a unique key on ID (ids are the same in every run of a date with
``id_mode='md5'``) or append to a staging table and merge from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .adapters import dt_key


def write_push_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str],
                    batchsize: int = 1000, num_partitions: int | None = None) -> None:
    w = rows.write.mode("append").option("batchsize", str(batchsize))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url, table, properties=dict(properties))


def write_push_parquet(rows: DataFrame, path: str, run_dt: str) -> None:
    """Replace the run date's partition only (dynamic partition overwrite); ids are
    deterministic, so a re-run writes the same rows."""
    (rows.withColumn("dt", F.lit(dt_key(run_dt)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(path))
