"""The daily jobs as they run in production: read the state of day n-1, read day n, write what day n changes.

Inputs are DataFrames with the job's columns (FIXTURES.md section 1) and a ``dt``
column; the day is selected with a typed predicate (partition pruning on a
dt-partitioned table). Each job takes exactly one run date, like the original
jobs, plus paths; it returns the snapshot path it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import interest, profile, push, slots
from ..session import cut_lineage, scratch_scope
from ..sources import snapshots as S
from ..sources.adapters import dt_key
from ..sources.published import publish
from ..sources.sinks import write_push_jdbc, write_push_parquet


def _day(df: DataFrame, dt: str) -> DataFrame:
    return df.where(F.col("dt") == F.lit(dt_key(dt)))


def _previous(store: S.StateStore, dt: str, prev_dt: str | None) -> str | None:
    """The date that the job of ``dt`` builds on: the one named, else the last one before it (None if there is none)."""
    return prev_dt or max((d for d in store.dates() if d < dt_key(dt)), default=None)


def interest_job(spark: SparkSession, behavior: DataFrame, state_base: str, dt: str,
                 prev_dt: str | None = None, expire: str = "drop", decay_inactive: bool = False,
                 keep_null_product: bool = False, decay: float = R.DECAY, threshold: float = R.THRESHOLD, **layout) -> str:
    """Daily interest weights: decayed merge of today's behaviour into the state of the day before.

    Today's rows are computed and written once, the state is scanned once for today's users and not
    moved, and the cells that changed are written as a delta (``layout``: see ``StateStore``).
    """
    store = S.interest_store(spark, state_base, **layout)
    prev_dt = _previous(store, dt, prev_dt)
    with scratch_scope(spark):
        today = cut_lineage(interest.daily_interest(_day(behavior, dt), keep_null_product), "interest-today")
        if decay_inactive and prev_dt:
            active = store.read(prev_dt)
        else:
            active = store.cells_of(prev_dt, today)
        store.commit(dt, prev_dt, interest.changed_cells(active, today, expire, decay, threshold))
    return S.snapshot_path(state_base, dt)


def slots_job(spark: SparkSession, browse: DataFrame, state_base: str, summary_base: str, dt: str,
              prev_dt: str | None = None, summary: str = "today", **layout) -> str:
    """Daily slot counts (additive) plus the summary cell of today's active users."""
    store, texts = S.slot_store(spark, state_base, **layout), S.summary_store(spark, summary_base, **layout)
    prev_dt = _previous(store, dt, prev_dt)
    # nothing is written before it is sure that both tables can be
    if prev_dt and dt_key(prev_dt) not in texts.dates():
        raise FileNotFoundError(f"{summary_base} has no summary of {dt_key(prev_dt)}, which the slots of {dt_key(dt)} build on: "
                                f"run the slots job of {dt_key(prev_dt)} again")
    with scratch_scope(spark):
        today = cut_lineage(slots.daily_slots(_day(browse, dt)), "slots-today")
        old = store.cells_of(prev_dt, today)
        new = cut_lineage(slots.merge_slots(old, today), "slots-merged")  # today's users' cells
        todays = slots.day_summary(new, today, summary)
        counted = new.join(today.select(F.col("user_id").alias("of"), F.col("slot").alias("in")),
                           F.col("user_id").eqNullSafe(F.col("of")) & F.col("slot").eqNullSafe(F.col("in")), "left_semi")
        # the summary first: a job that fails between the two leaves the slots' date as it was
        texts.commit(dt, prev_dt, todays.withColumn("deleted", F.lit(False)))
        store.commit(dt, prev_dt, counted.withColumn("deleted", F.lit(False)))
    return S.snapshot_path(state_base, dt)


def basic_tags_job(spark: SparkSession, member: DataFrame, cells_base: str, dt: str, prev_dt: str | None = None,
                   as_of=None, rule: str = "calendar", null_int_as_zero: bool = False, missing_birth: str = "zero", **layout) -> str:
    """Attribute tags upserted into the user_tags cells (cells not written stay): those whose value changed are written."""
    store = S.cell_store(spark, cells_base, **layout)
    prev_dt = _previous(store, dt, prev_dt)
    with scratch_scope(spark):
        cells = cut_lineage(profile.basic_tags_long(_day(member, dt), as_of=as_of, rule=rule, null_int_as_zero=null_int_as_zero,
                                                    missing_birth=missing_birth), "cells-today")
        changes = profile.changed_values(store.cells_of(prev_dt, cells), cells)
        store.commit(dt, prev_dt, changes.withColumn("deleted", F.lit(False)))
    return S.snapshot_path(cells_base, dt)


def push_job(spark: SparkSession, state_base: str, dt: str, seed: str = "max", exclude_seen: bool = False,
             parquet_path: str | None = None, jdbc: dict | None = None, id_mode: str = "md5", parts: str | None = None) -> list[str]:
    """Recommendations from the interest snapshot of ``dt`` (only its prod_tags family is read).

    Writes them to a parquet table, a JDBC table, a folder of published parts, or several, and returns where. The similarity's
    intermediate tables are deleted when the rows are written.
    """
    if not parquet_path and not jdbc and not parts:
        raise ValueError("name a parquet path, a folder for parts or a JDBC table to write to")
    written = []
    with scratch_scope(spark):
        state = S.read_snapshot(spark, state_base, dt, S.INTEREST_SCHEMA, families=[interest.PRODUCT_FAMILY])
        rows = push.push_rows(state, run_dt=dt, seed=seed, exclude_seen=exclude_seen, id_mode=id_mode)
        if sum(map(bool, (parquet_path, jdbc, parts))) > 1:  # all sinks get the same rows, also with random ids
            rows = cut_lineage(rows, "push-rows")
        if parquet_path:
            write_push_parquet(rows, parquet_path, dt)
            written.append(parquet_path)
        if parts:
            publish(rows, parts, dt)
            written.append(parts)
        if jdbc:
            write_push_jdbc(rows, **jdbc)
            written.append(jdbc["table"])
    return written


FAMILIES = (interest.TYPE_FAMILY, interest.PRODUCT_FAMILY, profile.SLOT_FAMILY, profile.ATTRIBUTE_FAMILY)


def profile_view(spark: SparkSession, dt: str, interest_base: str | None = None, slots_base: str | None = None,
                 summary_base: str | None = None, cells_base: str | None = None,
                 families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """The wanted families as text cells (user_id, family, tag, value) for one date.

    A family whose snapshot of that date is missing is an error, never left out.
    """
    unknown = set(families) - set(FAMILIES)
    if unknown or not families:
        raise ValueError(f"families must be among {FAMILIES}")
    parts = []
    weights = [f for f in families if f in (interest.TYPE_FAMILY, interest.PRODUCT_FAMILY)]

    def snapshot(base, schema, **kw):
        if base is None:
            raise ValueError(f"no snapshot folder given for one of {families}")
        return S.read_snapshot(spark, base, dt, schema, **kw)

    if weights:
        parts.append(profile.interest_cells(snapshot(interest_base, S.INTEREST_SCHEMA, families=weights)))
    if profile.SLOT_FAMILY in families:
        parts.append(profile.slot_cells(snapshot(slots_base, S.SLOT_SCHEMA)))
    if profile.ATTRIBUTE_FAMILY in families:
        parts.append(profile.summary_cells(snapshot(summary_base, S.SUMMARY_SCHEMA)))
        # the two hold different tags of the family, so neither replaces the other's cells
        parts.append(snapshot(cells_base, S.CELL_SCHEMA).select(*profile.KEYS, "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
