"""Profile store as a long table ``(user_id, family, tag, value)`` and its operators.

The store holds four families: ``user_tags`` (attribute codes and the slot
summary cell ``time_tags``), ``be_tags`` and ``prod_tags`` (interest weights as
two-decimal text), ``time_tags`` (slot counts as double text). Writes are
upserts by (user_id, family, tag): cells not written stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

KEYS = ["user_id", "family", "tag"]
ATTRIBUTE_FAMILY = "user_tags"
SLOT_FAMILY = "time_tags"
SUMMARY_TAG = "time_tags"


def tags_wide(df: DataFrame, rules: dict[str, Column], key: str = "id") -> DataFrame:
    """A rule set (tag name -> Column) applied to each row: one column per tag."""
    return df.select(F.col(key).alias("user_id"), *[c.alias(n) for n, c in rules.items()])


def tags_long(df: DataFrame, rules: dict[str, Column], family: str = ATTRIBUTE_FAMILY, key: str = "id") -> DataFrame:
    """A rule set applied to each row as cells (user_id, family, tag, value); map-only, no shuffle."""
    cells = F.array(*[F.struct(F.lit(n).alias("tag"), c.cast("string").alias("value")) for n, c in rules.items()])
    return df.select(F.col(key).alias("user_id"), F.lit(family).alias("family"), F.inline(cells))


def basic_tags_wide(member: DataFrame, as_of=None, rule: str = "calendar", null_int_as_zero: bool = False,
                    missing_birth: str = "zero") -> DataFrame:
    return tags_wide(member, R.basic_tag_columns(as_of, rule, null_int_as_zero, missing_birth))


def basic_tags_long(member: DataFrame, as_of=None, rule: str = "calendar", null_int_as_zero: bool = False,
                    missing_birth: str = "zero") -> DataFrame:
    """(user_id, family, tag, value): ten attribute cells per member (map-only, no shuffle)."""
    return tags_long(member, R.basic_tag_columns(as_of, rule, null_int_as_zero, missing_birth))


def location_tags(member: DataFrame) -> DataFrame:
    return tags_wide(member, R.location_tag_columns())


def upsert(profile: DataFrame, cells: DataFrame, families: tuple[str, ...] | None = None) -> DataFrame:
    """New snapshot = old cells whose key is not written now, plus the written cells.

    ``families`` names the families that ``cells`` writes: old cells of all others cannot be
    replaced and go through without a join (nor a scan of their partitions for it).
    """
    cells, old = cells.select(*KEYS, "value"), profile.select(*KEYS, "value")
    if families is None:
        return old.join(cells.select(*KEYS), KEYS, "left_anti").unionByName(cells)
    touched = F.coalesce(F.col("family").isin(*families), F.lit(False))
    kept = old.where(touched).join(cells.where(touched).select(*KEYS), KEYS, "left_anti")
    return old.where(~touched).unionByName(kept).unionByName(cells)


def changed_values(old: DataFrame, cells: DataFrame) -> DataFrame:
    """The cells whose key is new or whose value is not the old one."""
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in (*KEYS, "value")]
    return cells.select(*KEYS, "value").alias("new").join(old.select(*KEYS, "value").alias("old"), same, "left_anti")


def interest_cells(state: DataFrame) -> DataFrame:
    return state.select(*KEYS, F.col("weight").cast("string").alias("value"))


def slot_cells(slot_state: DataFrame) -> DataFrame:
    return slot_state.select("user_id", F.lit(SLOT_FAMILY).alias("family"), F.col("slot").alias("tag"),
                             R.java_double_text(F.col("n")).alias("value"))


def summary_cells(summary: DataFrame) -> DataFrame:
    return summary.select("user_id", F.lit(ATTRIBUTE_FAMILY).alias("family"), F.lit(SUMMARY_TAG).alias("tag"),
                          F.col("summary").alias("value"))


def family(profile: DataFrame, name: str) -> DataFrame:
    """Cells of one family (a partition filter when the snapshot is partitioned by family)."""
    return profile.where(F.col("family") == name).select("user_id", "tag", "value")


# --- key-set operations between yesterday's state and today's keys (active users only) ---

def _active_keys(prev: DataFrame, daily: DataFrame):
    old = prev.select(*KEYS)
    new = daily.select(*KEYS)
    active = daily.select("user_id").distinct()
    return old.join(active, "user_id", "left_semi"), new


def tags_intersect(prev: DataFrame, daily: DataFrame) -> DataFrame:
    old, new = _active_keys(prev, daily)
    return old.join(new, KEYS, "left_semi")


def tags_lost(prev: DataFrame, daily: DataFrame) -> DataFrame:
    old, new = _active_keys(prev, daily)
    return old.join(new, KEYS, "left_anti")


def tags_gained(prev: DataFrame, daily: DataFrame) -> DataFrame:
    old, new = _active_keys(prev, daily)
    return new.join(old, KEYS, "left_anti")


def tags_union(prev: DataFrame, daily: DataFrame) -> DataFrame:
    old, new = _active_keys(prev, daily)
    return old.unionByName(new).distinct()
