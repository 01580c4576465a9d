"""Connected components of a link table, as rounds of star contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage, drop_path


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node moves its links to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u != v"))
    # small star: a node hands its smaller neighbours, and itself, to the least of them
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
             .unionByName(low.select("u", F.col("m").alias("v"))))
    return small.distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): for every node with a link, the least node it can reach.

    ``edges`` has integer columns u and v. Each round is written to the checkpoint folder, so the plan
    stays small and a lost executor costs one round; the only driver-side values are two aggregates.
    """
    # every link starts as a star towards its smaller end
    now = cut_lineage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = None
    while True:
        new_state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new_state == state or not new_state[0]:
            break
        state = new_state
        done = getattr(now, "_tagloom_path", None)
        now = cut_lineage(_round(now), name)
        if done:
            drop_path(edges.sparkSession, done)
    # stable: every node but the least of its component has one link, to the least
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
