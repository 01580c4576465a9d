"""Interest weights with decay, expiry and two-decimal rounding (the daily behaviour job).

State is long form ``(user_id, family, tag, weight decimal(18,2))`` with family
``be_tags`` (type interest) or ``prod_tags`` (product interest, tag ``prod_<id>``).
Day n's state is a function of day n-1's state and day n's behaviour rows:

known user (history in both families), key in old and/or new:
    raw = (old + new) * 0.75; written rounded half-up when raw > 0.5, else dropped
    (``expire='keep_stale'`` keeps the old cell instead)
new user (history missing in a family): today's keys -> new * 0.75 (no threshold);
    old keys not seen today stay as they are
user without rows today: unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import cut_lineage, drop_path

WEIGHT = T.DecimalType(18, 2)
STATE_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("weight", WEIGHT),
])
TYPE_FAMILY, PRODUCT_FAMILY = "be_tags", "prod_tags"


def weight_rows(df: DataFrame, rules: dict[str, tuple[Column, Column]], key: str = "id") -> DataFrame:
    """A weight rule set: family -> (tag Column, weight Column) per row, giving
    (user_id, dt, family, tag, w); a rule whose tag is NULL emits no row."""
    cells = [F.when(tag.isNotNull(), F.struct(F.lit(fam).alias("family"), tag.alias("tag"), w.alias("w")))
             for fam, (tag, w) in rules.items()]
    rows = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return df.select(F.col(key).alias("user_id"), "dt", F.inline(rows))


def interest_rules(keep_null_product: bool = False) -> dict[str, tuple[Column, Column]]:
    """The behaviour rule set: a type tag and a product tag per behaviour row.

    A blank or NULL type becomes the pseudo tag ``type_id`` with weight 0; a NULL
    or blank product gives no product row (``keep_null_product`` writes ``prod_null``,
    and a blank product ``prod_``). The family comes from the source column, never
    from the tag text.
    """
    w = R.behaviour_weight("behavior_id")
    blank_type = R.is_blank(F.col("type_id"))
    pid = F.col("prod_id")
    if keep_null_product:
        prod_tag = F.concat(F.lit(R.PRODUCT_PREFIX), F.coalesce(pid, F.lit("null")))
    else:
        prod_tag = F.when(~R.is_blank(pid), F.concat(F.lit(R.PRODUCT_PREFIX), pid))
    return {
        TYPE_FAMILY: (F.when(blank_type, F.lit(R.BLANK_TYPE_TAG)).otherwise(F.col("type_id")),
                      F.when(blank_type, F.lit(0)).otherwise(w)),
        PRODUCT_FAMILY: (prod_tag, w),
    }


def tag_rows(behavior: DataFrame, keep_null_product: bool = False) -> DataFrame:
    """Behaviour rows -> (user_id, dt, family, tag, w): one type row and at most one product row."""
    return weight_rows(behavior, interest_rules(keep_null_product))


def daily_interest(behavior: DataFrame, keep_null_product: bool = False, by_day: bool = False) -> DataFrame:
    """Sum of behaviour weights per (user, family, tag) [per dt with ``by_day``]; partial aggregation map-side."""
    keys = ["user_id", "family", "tag"] + (["dt"] if by_day else [])
    return (tag_rows(behavior, keep_null_product).groupBy(*keys)
            .agg(F.sum("w").cast(WEIGHT).alias("new_w")))


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def _decimal(x: float) -> tuple[Decimal, int]:
    d = Decimal(repr(float(x)))
    scale = max(2, -d.as_tuple().exponent)
    if scale > 12 or abs(d) >= 10**6:
        raise ValueError(f"{x!r} has more digits than a weight parameter can have")
    return d, scale


def decimal_literal(x: float) -> str:
    """A parameter as an SQL decimal of just its own digits (nothing is rounded)."""
    d, scale = _decimal(x)
    return f"CAST('{d:f}' AS DECIMAL({scale + 6},{scale}))"


def _merged_sql(active: str, daily: str, expire: str, decay: float, threshold: float) -> str:
    """SQL for (user_id, family, tag, old_w, weight) of today's users: each cell before and after the day (null: no such cell).

    ``active`` holds their cells of the day before, ``daily`` today's rows. Cells are grouped by (user,
    family, tag), so a user with very many tags is spread over tasks; the known-user flag is a partially
    aggregated row per user that is joined back, where AQE can split a heavy user too.
    """
    if expire not in ("drop", "keep_stale"):
        raise ValueError("expire must be 'drop' or 'keep_stale'")
    w = "DECIMAL(18,2)"
    dec, thr = decimal_literal(decay), decimal_literal(threshold)
    stale = "old_w" if expire == "keep_stale" else f"CAST(NULL AS {w})"
    return f"""
WITH active AS ({active}),
known AS (
  SELECT user_id FROM active WHERE old_w IS NOT NULL GROUP BY user_id
  HAVING MAX(CAST(family = '{TYPE_FAMILY}' AS INT)) = 1 AND MAX(CAST(family = '{PRODUCT_FAMILY}' AS INT)) = 1),
cells AS (
  SELECT user_id, family, tag, MAX(old_w) AS old_w, MAX(new_w) AS new_w
  FROM (SELECT user_id, family, tag, old_w, CAST(NULL AS {w}) AS new_w FROM active
        UNION ALL SELECT user_id, family, tag, CAST(NULL AS {w}), CAST(new_w AS {w}) FROM {daily}) c
  GROUP BY user_id, family, tag)
SELECT c.user_id, c.family, c.tag, c.old_w,
       CASE WHEN k.user_known THEN CASE WHEN raw > {thr} THEN CAST(ROUND(raw, 2) AS {w}) ELSE {stale} END
            WHEN c.new_w IS NOT NULL THEN CAST(ROUND(c.new_w * {dec}, 2) AS {w})
            ELSE c.old_w END AS weight
FROM (SELECT *, (COALESCE(old_w, CAST(0 AS {w})) + COALESCE(new_w, CAST(0 AS {w}))) * {dec} AS raw FROM cells) c
LEFT JOIN (SELECT user_id, TRUE AS user_known FROM known) k ON c.user_id <=> k.user_id"""


@contextmanager
def _views(**frames: DataFrame):
    """Temporary views of the frames under names of their own; the plans made inside hold the frames' plans."""
    key = uuid.uuid4().hex[:12]
    names = {n: f"tagloom_{n}_{key}" for n in frames}
    for n, df in frames.items():
        df.createOrReplaceTempView(names[n])
    try:
        yield names
    finally:
        for n, df in frames.items():
            df.sparkSession.catalog.dropTempView(names[n])


def merge_interest(prev: DataFrame, daily: DataFrame, expire: str = "drop",
                   decay: float = R.DECAY, threshold: float = R.THRESHOLD,
                   decay_inactive: bool = False) -> DataFrame:
    """One daily step: state(n-1) x daily aggregate(n) -> state(n).

    ``decay_inactive=True`` also decays (and expires) known users without rows
    today; by default they are left untouched, as the original job does.

    Plan: only today's users take part. A semi join with today's rows picks their
    cells from yesterday's state (broadcast if the ids are small in bytes); cells of
    other users go straight to the output through the anti join. No window or partition
    holds all cells of a user. The job (``plans/jobs.py``) writes ``changed_cells`` instead.
    """
    cells = prev.select("user_id", "family", "tag", F.col("weight").cast(WEIGHT).alias("old_w"))
    with _views(prev=cells, day=daily.select("user_id", "family", "tag", "new_w")) as v:
        before, others = f"SELECT * FROM {v['prev']}", ""
        if not decay_inactive:  # otherwise every known user decays
            others = f" UNION ALL SELECT b.* FROM {v['prev']} b LEFT ANTI JOIN {v['day']} u ON b.user_id <=> u.user_id WHERE old_w IS NOT NULL"
            before = f"SELECT b.* FROM {v['prev']} b LEFT SEMI JOIN {v['day']} u ON b.user_id <=> u.user_id"
        merged = _merged_sql(before, v["day"], expire, decay, threshold)
        return prev.sparkSession.sql(f"SELECT user_id, family, tag, weight FROM ({merged}) m WHERE weight IS NOT NULL{others}")


def changed_cells(active: DataFrame, daily: DataFrame, expire: str = "drop", decay: float = R.DECAY,
                  threshold: float = R.THRESHOLD) -> DataFrame:
    """(user_id, family, tag, weight, deleted): the cells that the day writes anew or, with ``deleted``, ends.

    ``active`` has the cells of the day before that take part: today's users', or with decay of inactive users all.
    """
    cells = active.select("user_id", "family", "tag", F.col("weight").cast(WEIGHT).alias("old_w"))
    with _views(active=cells, day=daily.select("user_id", "family", "tag", "new_w")) as v:
        merged = _merged_sql(f"SELECT * FROM {v['active']}", v["day"], expire, decay, threshold)
        return active.sparkSession.sql(f"SELECT user_id, family, tag, weight, weight IS NULL AS deleted FROM ({merged}) m "
                                       "WHERE NOT (weight <=> old_w)")


def replay_interest(behavior: DataFrame, days: Iterable[str], prev: DataFrame | None = None,
                    expire: str = "drop", checkpoint_every: int | None = None,
                    keep_null_product: bool = False, decay_inactive: bool = False,
                    decay: float = R.DECAY, threshold: float = R.THRESHOLD) -> DataFrame:
    """The state after the daily jobs of the days, in order (day n reads the state day n-1 wrote).

    The daily aggregates of all days are computed in one pass over the behaviour rows and written
    once. By default the days are folded (``_folded``), in a number of jobs that does not grow with them. With
    ``checkpoint_every`` they run one after the other, and that often a day's state is written to the
    shared checkpoint folder and the superseded one deleted.
    """
    days = list(days)
    spark = behavior.sparkSession
    per_day = daily_interest(behavior.where(F.col("dt").isin(*days)), keep_null_product, by_day=True)
    if len(days) > 1:
        # each step reads its day more than once, and the day filter is pushed below the aggregate
        per_day = cut_lineage(per_day, "interest-daily", partition_by=("dt",) if checkpoint_every else ())
    if not checkpoint_every and len(set(days)) == len(days) > 1:
        return _folded(per_day, days, prev, expire, decay_inactive, decay, threshold)
    state = prev if prev is not None else empty_state(spark)
    written = None
    for i, d in enumerate(days, 1):
        state = merge_interest(state, per_day.where(F.col("dt") == d), expire=expire,
                               decay_inactive=decay_inactive, decay=decay, threshold=threshold)
        if i % (checkpoint_every or 1) == 0 and i < len(days):
            state = cut_lineage(state, f"interest-state-{d}")
            if written is not None:  # the new table no longer reads the previous one
                drop_path(spark, written)
            written = getattr(state, "_tagloom_path", None)
    return state


WORD = 62  # days whose presence one long holds


def _bits(days: str, word: int) -> str:
    """SQL for the days of one word of an array, as a bit each."""
    return f"aggregate(filter({days}, d -> d DIV {WORD} = {word}), 0L, (a, d) -> a | shiftleft(1L, d % {WORD}))"


def _times(base: np.ndarray, by: int, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """base * by, exactly, and that divided by unit and rounded half away from zero."""
    if base.size and max(int(base.max()), -int(base.min())) * abs(by) + unit >= 1 << 63:
        base = base.astype(object)  # Python's integers
    raw = base * by
    return raw, np.where(raw < 0, -1, 1) * ((abs(raw) + unit // 2) // unit)


def _course(n_days: int, keep_stale: bool, decay: tuple[Decimal, int], threshold: tuple[Decimal, int]):
    """Batches of cells (user_id, family, tag, cur, news, t0.., k0..) folded over their users' days.

    Weights are in hundredths, as integers. t has a bit for each day on which the user takes part, k for those of them on which
    they are known; the result has one for each of them after which the cell is there.
    """
    unit = 10 ** decay[1]
    by = int(decay[0].scaleb(decay[1]))
    least = int(threshold[0].scaleb(threshold[1])) * 100 * unit // 10 ** threshold[1]  # in units of weight * decay

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        old, news, size = batch.column("cur"), batch.column("news"), batch.num_rows
        has, cur = pc.is_valid(old).to_numpy(zero_copy_only=False), pc.fill_null(old, 0).to_numpy().copy()
        entries = news.flatten()
        cell = np.repeat(np.arange(size), pc.fill_null(pc.list_value_length(news), 0).to_numpy())
        day, new = entries.field("i").to_numpy(zero_copy_only=False), entries.field("n").to_numpy(zero_copy_only=False)
        order = np.argsort(day, kind="stable")
        cell, day, new = cell[order], day[order], new[order]
        starts = np.searchsorted(day, np.arange(n_days + 1))
        words = range(-(-n_days // WORD))
        takes, knows = ([batch.column(f"{c}{j}").to_numpy() for j in words] for c in "tk")
        there = [np.zeros(size, np.int64) for _ in words]
        n, n_has = np.zeros(size, np.int64), np.zeros(size, bool)
        for d in range(n_days):
            word, bit = divmod(d, WORD)
            at = np.nonzero(takes[word] >> bit & 1)[0]
            if not len(at):
                continue
            of_day = slice(starts[d], starts[d + 1])
            n[cell[of_day]], n_has[cell[of_day]] = new[of_day], True
            c, h, x, seen, known = cur[at], has[at], n[at], n_has[at], (knows[word][at] >> bit & 1).astype(bool)
            raw, rounded = _times(np.where(known, c + x, x), by, unit)
            high = (raw > least).astype(bool)
            stays = np.where(known, high | (h & keep_stale), True) & (h | seen)
            after = np.where(stays, np.where(np.where(known, high, seen), rounded, c), 0)
            if len(after) and max(int(after.max()), -int(after.min())) >= 10**18:
                raise OverflowError("a weight is too large for DECIMAL(18,2)")
            cur[at], has[at] = after.astype(np.int64), stays
            there[word][at] |= stays.astype(np.int64) << bit
            n[cell[of_day]], n_has[cell[of_day]] = 0, False
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("user_id", "family", "tag")), pa.array(cur, mask=~has), *map(pa.array, there)],
                                          names=["user_id", "family", "tag", "cur", *(f"w{j}" for j in words)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(fold, batches)

    return run


def _folded(per_day: DataFrame, days: list[str], prev: DataFrame | None, expire: str, decay_inactive: bool,
            decay: float, threshold: float) -> DataFrame:
    """The state after all days, folding every cell over its user's days.

    A cell's course depends on other cells only through its user's known flags, one for each day on which the user
    takes part: whether both families had a cell before it. With flags given, cells are folded
    independently of each other, a batch at a time (``_course``); each says after which days it
    is there, in bits that are joined by user and family into the flags that hold. The first
    flags assume that no family ever expires whole; if the flags that come out differ, the cells are folded again. Flags of the first k days are
    right after k rounds, and mostly all are after one or two. Users of few days cost few entries.
    """
    if expire not in ("drop", "keep_stale"):
        raise ValueError("expire must be 'drop' or 'keep_stale'")
    spark, w = per_day.sparkSession, "DECIMAL(18,2)"
    words = range(-(-len(days) // WORD))
    number = F.array_position(F.array(*[F.lit(d) for d in days]), F.col("dt")) - 1
    rows = per_day.select("user_id", "family", "tag", number.cast("int").alias("i"), F.col("new_w").cast(WEIGHT).alias("new_w"))
    before = (prev if prev is not None else empty_state(spark)).select("user_id", "family", "tag", F.col("weight").cast(WEIGHT).alias("old_w"))
    with _views(rows=rows, before=before.where("old_w IS NOT NULL")) as v:
        taking = (f"SELECT user_id FROM {v['rows']} UNION SELECT user_id FROM {v['before']}" if decay_inactive
                  else f"SELECT DISTINCT user_id FROM {v['rows']}")
        active = f"SELECT b.* FROM {v['before']} b LEFT SEMI JOIN ({taking}) u ON b.user_id <=> u.user_id"
        cells = spark.sql(f"""
SELECT user_id, family, tag, CAST(MAX(old_w) * 100 AS BIGINT) AS cur, collect_list(IF(new_w IS NULL, NULL, struct(i, CAST(new_w * 100 AS BIGINT) AS n))) AS news
FROM (SELECT user_id, family, tag, CAST(NULL AS {w}) AS old_w, i, new_w FROM {v['rows']}
      UNION ALL SELECT user_id, family, tag, old_w, NULL, NULL FROM ({active}) a) c
GROUP BY user_id, family, tag""")
        cells = cut_lineage(cells, "interest-cells")
        own_days = f"sequence(0, {len(days) - 1})" if decay_inactive else "sort_array(collect_set(i))"
        firsts = [f"MIN(IF(family = '{f}', IF(was, -1, i), NULL))" for f in (TYPE_FAMILY, PRODUCT_FAMILY)]  # where the family begins
        users = spark.sql(f"""
SELECT user_id, days, was_known, transform(days, d -> COALESCE(d > GREATEST(a, b), false) AND a IS NOT NULL AND b IS NOT NULL) AS known
FROM (SELECT user_id, {own_days} AS days, {firsts[0]} AS a, {firsts[1]} AS b,
             COALESCE({firsts[0]} = -1 AND {firsts[1]} = -1, false) AS was_known
      FROM (SELECT user_id, family, i, false AS was FROM {v['rows']} UNION ALL SELECT user_id, family, NULL, true FROM ({active}) a) r
      GROUP BY user_id) u""")
        users = cut_lineage(users, "interest-users")
        others = None if decay_inactive or prev is None else spark.sql(
            f"SELECT b.user_id, b.family, b.tag, b.old_w AS weight FROM {v['before']} b LEFT ANTI JOIN {v['rows']} u ON b.user_id <=> u.user_id")
    while True:
        dealt = users.select(F.col("user_id").alias("u"), *[F.expr(_bits("days", j)).alias(f"t{j}") for j in words],
                             *[F.expr(_bits("filter(zip_with(days, known, (d, f) -> IF(f, d, NULL)), d -> d IS NOT NULL)", j)).alias(f"k{j}") for j in words])
        joined = cells.join(dealt, F.col("user_id").eqNullSafe(F.col("u"))).drop("u")
        schema = T.StructType([*STATE_SCHEMA.fields[:3], T.StructField("cur", T.LongType()), *[T.StructField(f"w{j}", T.LongType()) for j in words]])
        folded = joined.mapInArrow(_course(len(days), expire == "keep_stale", _decimal(decay), _decimal(threshold)), schema)
        weight = (F.col("cur").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(WEIGHT)
        folded = cut_lineage(folded.select("user_id", "family", "tag", weight.alias("weight"), *[f"w{j}" for j in words]), "interest-folded")
        there = [F.array(*[F.bit_or(F.when(F.col("family") == f, F.col(f"w{j}"))) for j in words]).alias(f) for f in (TYPE_FAMILY, PRODUCT_FAMILY)]
        per_user = folded.groupBy("user_id").agg(*there)
        # a family is there if it was after the user's day before
        on = [f"COALESCE(shiftright({f}[days[k - 1] DIV {WORD}], days[k - 1] % {WORD}) & 1, 0) = 1" for f in (TYPE_FAMILY, PRODUCT_FAMILY)]
        flags = F.expr(f"transform(days, (d, k) -> IF(k = 0, was_known, {on[0]} AND {on[1]}))")
        again = users.alias("u").join(per_user.alias("p"), F.col("u.user_id").eqNullSafe(F.col("p.user_id")), "left").select(
            "u.user_id", "days", "was_known", flags.alias("held"), "known")
        again = cut_lineage(again, "interest-users")
        if again.where("held != known").isEmpty():
            break
        users = again.select("user_id", "days", "was_known", F.col("held").alias("known"))
    out = folded.where("weight IS NOT NULL").select("user_id", "family", "tag", "weight")
    return out if others is None else out.unionByName(others)


def split_families(daily_tags: DataFrame) -> DataFrame:
    """Prefix form of the family split: one tag map per user, split by the ``prod_`` key prefix.

    Returned exploded (user_id, dt, family, tag, weight) so that it stays scalar.
    """
    fam = F.when(F.col("tag").startswith(R.PRODUCT_PREFIX), F.lit(PRODUCT_FAMILY)).otherwise(F.lit(TYPE_FAMILY))
    return (daily_tags.groupBy("user_id", "dt", "tag").agg(F.sum("w").cast(WEIGHT).alias("weight"))
            .select("user_id", "dt", fam.alias("family"), "tag", "weight"))


def sum_by_tag(rows: DataFrame) -> DataFrame:
    """Fold-merge of tag maps by summing equal keys, in long form: (user_id, family, tag) -> w."""
    return rows.groupBy("user_id", "family", "tag").agg(F.sum("w").cast("bigint").alias("w"))


def tag_map(rows: DataFrame, family: str, by=("user_id", "dt")) -> DataFrame:
    """Edge form of one family: a tag -> weight map per (user, day).

    Only for a family with a bounded tag vocabulary (the type tags): the map holds
    all of a user's tags of that family for the day.
    """
    summed = (rows.where(F.col("family") == family).groupBy(*by, "tag")
              .agg(F.sum("w").cast("bigint").alias("w")))
    return summed.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("tag", "w"))).alias("tags"))


def merge_maps(a, b):
    """Two tag maps merged by summing equal keys (a key missing on one side counts 0)."""
    return F.map_zip_with(a, b, lambda _k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def interest_text(state: DataFrame) -> DataFrame:
    """Cells as the store holds them: weight formatted with two decimals."""
    return state.select("user_id", "family", "tag", F.col("weight").cast("string").alias("value"))


def known_users(prev: DataFrame, daily: DataFrame) -> DataFrame:
    hist = (prev.groupBy("user_id").agg(F.countDistinct("family").alias("nf"))
            .where(F.col("nf") == 2).select("user_id"))
    return daily.select("user_id").distinct().join(hist, "user_id", "left_semi")


def new_users(prev: DataFrame, daily: DataFrame) -> DataFrame:
    hist = (prev.groupBy("user_id").agg(F.countDistinct("family").alias("nf"))
            .where(F.col("nf") == 2).select("user_id"))
    return daily.select("user_id").distinct().join(hist, "user_id", "left_anti")
