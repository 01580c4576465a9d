"""Parquet table access.

Small dimensions carry no broadcast hint: Spark broadcasts a join side only if its size in bytes (file
sizes when planning, measured shuffle sizes at run time) is under spark.sql.autoBroadcastJoinThreshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the driver fixture; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
