"""Browse counts per time-of-day slot (the daily browse job).

State is long form ``(user_id, slot, n bigint)``. The merge is additive with no
decay: key in both -> old + new, only new -> new, only old -> untouched. Each
daily run also writes a summary cell per active user: today's slots with their
cumulative counts, sorted by count descending (ties by slot code), rendered as
``List((015001,4.0), (015002,2.0))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from .interest import weight_rows

STATE_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("slot", T.StringType()),
    T.StructField("n", T.LongType()),
])


def slot_rules() -> dict[str, tuple[Column, Column]]:
    """The browse rule set: the slot of the row's hour with weight 1 (0 for the pseudo slot)."""
    slot = R.slot_of_hour(R.hour_of("browse_time"))
    return {"time_tags": (slot, R.slot_weight(slot))}


def slot_rows(browse: DataFrame) -> DataFrame:
    """One row per browse event: (user_id, dt, slot, n) with n = 1, or 0 for the pseudo slot."""
    rows = weight_rows(browse, slot_rules())
    return rows.select("user_id", "dt", F.col("tag").alias("slot"), F.col("w").alias("n"))


def daily_slots(browse: DataFrame, by_day: bool = False) -> DataFrame:
    keys = ["user_id"] + (["dt"] if by_day else []) + ["slot"]
    return slot_rows(browse).groupBy(*keys).agg(F.sum("n").cast("bigint").alias("n"))


def numbered_days(per_day: DataFrame) -> DataFrame:
    """yyyyMMdd text dates as integers, which aggregate without sorting."""
    return per_day.withColumn("dt", F.col("dt").cast("int"))


def merge_slots(prev: DataFrame, daily: DataFrame) -> DataFrame:
    """state(n-1) x today's counts -> state(n).

    The merge is purely additive (both -> old + new, only new -> new, only old ->
    unchanged), i.e. a sum over the union: one partially aggregated shuffle on
    (user_id, slot) instead of a full outer join.
    """
    return (prev.select("user_id", "slot", "n").unionByName(daily.select("user_id", "slot", "n"))
            .groupBy("user_id", "slot").agg(F.sum("n").cast("bigint").alias("n")))


def summary_text(pairs: Column) -> Column:
    """array<struct<slot, n>> -> 'List((slot,n.0), ...)' sorted by n desc, slot asc."""
    keyed = F.transform(pairs, lambda p: F.struct((-p["n"]).alias("k"), p["slot"].alias("slot"), p["n"].alias("n")))
    items = F.transform(F.array_sort(keyed),
                        lambda p: F.concat(F.lit("("), p["slot"], F.lit(","), R.java_double_text(p["n"]), F.lit(")")))
    return F.concat(F.lit("List("), F.array_join(items, ", "), F.lit(")"))


def day_summary(new_state: DataFrame, daily: DataFrame, summary: str = "today") -> DataFrame:
    """Summary of one daily run for each active user: today's slots with cumulative counts
    (``summary='all'``: every slot the user has)."""
    if summary == "today":
        today = daily.select("user_id", "slot").join(new_state, ["user_id", "slot"])
    elif summary == "all":
        today = new_state.join(daily.select("user_id").distinct(), "user_id", "left_semi")
    else:
        raise ValueError("summary must be 'today' or 'all'")
    return (today.groupBy("user_id")  # at most six slots per user: a bounded group
            .agg(summary_text(F.collect_list(F.struct("slot", "n"))).alias("summary")))


def history_summary(per_day: DataFrame, summary: str = "today") -> DataFrame:
    """Summary cell after replaying every day, without a day-by-day fold.

    The merge is additive, so the cumulative count on a user's last active day is
    the user's total; the cell holds the slots of that last day (all slots with
    ``summary='all'``). One pass: the total and the last day of every (user, slot),
    then one bounded group of slots per user. With an integer ``dt`` both are hash
    aggregates (``numbered_days``); text dates give the same result through sorts.
    """
    return summary_of_cells(history_cells(per_day), summary)


def history_cells(per_day: DataFrame) -> DataFrame:
    """(user_id, slot, n, last): the total of every (user, slot) and the last day it was seen."""
    return per_day.groupBy("user_id", "slot").agg(F.sum("n").cast("bigint").alias("n"), F.max("dt").alias("last"))


def summary_of_cells(cells: DataFrame, summary: str = "today") -> DataFrame:
    """The summary cell of each user from ``history_cells``."""
    if summary not in ("today", "all"):
        raise ValueError("summary must be 'today' or 'all'")
    slots = F.collect_list(F.struct("slot", "n", "last"))  # at most six slots per user
    by_user = cells.groupBy("user_id").agg(slots.alias("slots"), F.max("last").alias("last"))
    kept = F.col("slots") if summary == "all" else F.filter("slots", lambda s: s["last"] == F.col("last"))
    return by_user.select("user_id", summary_text(kept).alias("summary"))
