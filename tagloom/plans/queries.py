"""Registered queries: name -> (Spark callable (spark, sf_dir) -> DataFrame, DuckDB SQL or None).

Every query reads the driver's tables (or what Spark derives from them) with no
sampling, id subsets or row caps. Queries on the profile and the push read the
state after every day of the events table; a few show one daily step, its key sets
or its days by name (``merge_interest_day``, ``merge_interest_3days``,
``merge_slots_day``, ``known_users``, ``new_users``, ``tags_*``), because one day is the operator. ``push_preview`` is the only limit, because a
ten-row preview is the operator.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonfn as J
from ..functions import rules as R
from ..operators import enrich, interest, pair_state, profile, push, similarity, slots
from ..session import cut_lineage, scratch_folder
from ..sources import adapters as A
from ..sources import snapshots as S
from ..sources.tables import table
from . import jobs
from . import oracle as O

AS_OF = "2018-07-15"
DAY1, DAY2, DAY3 = O.DAY1, O.DAY2, O.DAY3
LATER = 3  # days that the queries on kept tables run one by one
LAYOUT = {"buckets": 8, "compact_share": 100.0}  # few buckets for small fixtures, and deltas however much a day changes
ALL_DAYS = O.ALL_DAYS
LAST = f"s{len(ALL_DAYS)}"  # the oracle's state after all days

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# --- shared building blocks -------------------------------------------------------

def _member(spark, sf):
    return A.member(spark, sf)


def _state(spark, sf, days, **options):
    return interest.replay_interest(A.behavior(spark, sf, days=list(days)), days, **options)


def _full_state(spark, sf, **options):
    """The state after every day of the events table."""
    return _state(spark, sf, A.event_days(spark, sf), **options)


def _snapshot(spark, sf):
    """The full state as the push job sees it: the interest job's written snapshot (read several times)."""
    return cut_lineage(_full_state(spark, sf), "interest-snapshot")


def _day(spark, sf, dt):
    return interest.daily_interest(A.behavior(spark, sf, dt))


def _basic(spark, sf, **kw):
    return profile.basic_tags_wide(_member(spark, sf), as_of=AS_OF, **kw)


def W(body, *ctes):  # noqa: N802 - short alias for WITH-assembly
    return O.with_(list(ctes), body)


MB = [O.MEMBER, O.AGED]

# --- scans --------------------------------------------------------------------------

register("scan_member", W("SELECT * FROM member WHERE dt = '20240101'", O.MEMBER))(
    lambda s, sf: _member(s, sf).where(F.col("dt") == A.dt_key("20240101")))
register("scan_behavior", W("SELECT id, type_id, prod_id, behavior_id, dt FROM behavior", O.EV, O.BEHAVIOR))(
    lambda s, sf: A.behavior(s, sf))
register("scan_browse", W("SELECT id, browse_time, dt FROM browse", O.EV, O.BROWSE))(
    lambda s, sf: A.browse(s, sf))


def _partition(df: DataFrame, dt: str) -> DataFrame:
    """One day of a daily table: the whole table is kept by dt, and the scan prunes all other partitions."""
    return cut_lineage(df, "daily-table", partition_by=("dt",)).where(F.col("dt") == dt)


register("scan_behavior_partition", W(f"SELECT id, type_id, prod_id, behavior_id, dt FROM behavior WHERE dt = '{DAY2}'",
                                      O.EV, O.BEHAVIOR))(lambda s, sf: _partition(A.behavior(s, sf), DAY2))
register("scan_browse_partition", W(f"SELECT id, browse_time, dt FROM browse WHERE dt = '{DAY2}'", O.EV, O.BROWSE))(
    lambda s, sf: _partition(A.browse(s, sf), DAY2))


def _latest_member(s, sf):
    """The member partition of the latest day of behaviour: the day comes out of another table while the query runs."""
    days = A.event_days(s, sf)[-LATER:]
    members = A.member(s, sf, days[0])
    kept = reduce(DataFrame.unionByName, [members.withColumn("dt", F.lit(d)) for d in days])
    kept = cut_lineage(kept, "member-table", partition_by=("dt",))
    return A.of_latest_day(kept, A.behavior(s, sf))


register("scan_member_latest", W("SELECT * REPLACE ((SELECT max(dt) FROM behavior) AS dt) FROM member", O.EV, O.BEHAVIOR, O.MEMBER))(_latest_member)
register("scan_profile_family", W(f"SELECT user_id, tag, weight FROM {LAST} WHERE family = 'prod_tags'",
                                  *O.interest_ctes(ALL_DAYS)))(
    lambda s, sf: push.product_family(_full_state(s, sf)))

# --- attribute rules ----------------------------------------------------------------


def _attr(name: str, col_fn, sql_expr: str):
    register(name, W(f"SELECT id AS user_id, {sql_expr} AS value FROM aged", *MB))(
        lambda s, sf: _member(s, sf).select(F.col("id").alias("user_id"), col_fn().alias("value")))


_attr("tag_gender", lambda: R.gender_tag(), O.GENDER)
_attr("tag_age_band", lambda: R.age_tag("birth", AS_OF), O.band(O.age_expr()))
_attr("tag_deformity", lambda: R.deformity_tag(), O.DEFORMITY)
_attr("tag_education", lambda: R.education_tag(), O.EDUCATION)
_attr("tag_position", lambda: R.text_or_unknown("position"), O.text_or_unknown("position"))
_attr("tag_hobby", lambda: R.text_or_unknown("hobby"), O.text_or_unknown("hobby"))
_attr("tag_terminal", lambda: R.terminal_tag(), O.TERMINAL)
_attr("tag_province", lambda: R.text_or_unknown("province"), O.text_or_unknown("province"))
_attr("tag_city", lambda: R.text_or_unknown("city"), O.text_or_unknown("city"))
_attr("tag_city_level", lambda: R.city_level_tag(), O.city_level())
_attr("tag_age_band_reference", lambda: R.age_tag("birth", AS_OF, rule="reference"),
      O.band(O.age_expr("reference")))
_attr("tag_age_band_missing_unknown", lambda: R.age_tag("birth", AS_OF, missing_birth="unknown"),
      f"CASE WHEN birth IS NULL OR length(birth) < 4 THEN 'unknown' ELSE {O.band(O.age_expr())} END")
register("tag_null_int_as_zero", W(f"SELECT id AS user_id, {O.GENDER_NULL_AS_ZERO} AS gender, "
                                   f"{O.TERMINAL_NULL_AS_ZERO} AS terminal_type FROM member", O.MEMBER))(
    lambda s, sf: _member(s, sf).select(F.col("id").alias("user_id"),
                                        R.gender_tag("gender", True).alias("gender"),
                                        R.terminal_tag("terminal_type", True).alias("terminal_type")))
register("age_years", W(f"SELECT id AS user_id, birth, {O.age_expr()} AS age FROM aged", *MB))(
    lambda s, sf: _member(s, sf).select(F.col("id").alias("user_id"), "birth",
                                        R.age_years("birth", AS_OF).alias("age")))
register("age_years_reference", W(f"SELECT id AS user_id, birth, {O.age_expr('reference')} AS age FROM aged", *MB))(
    lambda s, sf: _member(s, sf).select(F.col("id").alias("user_id"), "birth",
                                        R.age_years("birth", AS_OF, rule="reference").alias("age")))
register("basic_tags_wide", W("SELECT * FROM basic", *MB, O.BASIC))(
    lambda s, sf: _basic(s, sf))
register("basic_tags_long", W("SELECT * FROM basic_long", *MB, O.BASIC, O.BASIC_LONG))(
    lambda s, sf: profile.basic_tags_long(_member(s, sf), as_of=AS_OF))
register("location_tags", W(f"SELECT id AS user_id, province, city, {O.city_level('未知')} AS city_level FROM member",
                            O.MEMBER))(
    lambda s, sf: profile.location_tags(_member(s, sf)))

# --- interest -------------------------------------------------------------------------

register("behavior_weight", W("SELECT user_id AS id, dt, behavior_id, w AS weight FROM bw",
                              O.EV, O.BEHAVIOR, O.BW))(
    lambda s, sf: A.behavior(s, sf).select("id", "dt", "behavior_id", R.behaviour_weight().alias("weight")))
register("type_interest_day", W("SELECT user_id, dt, tag, new_w AS weight FROM daily WHERE family = 'be_tags'",
                                *O.INTEREST_BASE))(
    lambda s, sf: interest.daily_interest(A.behavior(s, sf), by_day=True)
    .where(F.col("family") == interest.TYPE_FAMILY).select("user_id", "dt", "tag", F.col("new_w").alias("weight")))
register("product_interest_day", W("SELECT user_id, dt, tag, new_w AS weight FROM daily WHERE family = 'prod_tags'",
                                   *O.INTEREST_BASE))(
    lambda s, sf: interest.daily_interest(A.behavior(s, sf), by_day=True)
    .where(F.col("family") == interest.PRODUCT_FAMILY).select("user_id", "dt", "tag", F.col("new_w").alias("weight")))
register("product_interest_keep_null", W(
    "SELECT user_id, dt, 'prod_' || COALESCE(prod_id, 'null') AS tag, CAST(SUM(w) AS DECIMAL(18,2)) AS weight "
    "FROM bw GROUP BY user_id, dt, 'prod_' || COALESCE(prod_id, 'null')", O.EV, O.BEHAVIOR, O.BW))(
    lambda s, sf: interest.daily_interest(A.behavior(s, sf), keep_null_product=True, by_day=True)
    .where(F.col("family") == interest.PRODUCT_FAMILY).select("user_id", "dt", "tag", F.col("new_w").alias("weight")))
register("split_families", W(
    "SELECT user_id, dt, CASE WHEN starts_with(tag, 'prod_') THEN 'prod_tags' ELSE 'be_tags' END AS family, tag, "
    "CAST(SUM(w) AS DECIMAL(18,2)) AS weight FROM tagrows GROUP BY user_id, dt, tag",
    O.EV, O.BEHAVIOR, O.BW, O.TAGROWS))(
    lambda s, sf: interest.split_families(interest.tag_rows(A.behavior(s, sf))))
register("map_merge_sum", W("SELECT user_id, family, tag, CAST(SUM(w) AS BIGINT) AS w FROM tagrows "
                            "GROUP BY user_id, family, tag", O.EV, O.BEHAVIOR, O.BW, O.TAGROWS))(
    lambda s, sf: interest.sum_by_tag(interest.tag_rows(A.behavior(s, sf))))


def _map_zip_merge(s, sf):
    """A user's daily type maps, folded into one by merging two at a time."""
    maps = interest.tag_map(interest.tag_rows(A.behavior(s, sf)), interest.TYPE_FAMILY)
    per_user = maps.groupBy("user_id").agg(F.collect_list("tags").alias("days"))  # a map a day, of a bounded vocabulary
    merged = F.aggregate("days", F.create_map().cast("map<string,bigint>"), interest.merge_maps)
    return per_user.select("user_id", F.explode(merged).alias("tag", "w"))


register("map_zip_merge", W("SELECT user_id, tag, CAST(SUM(w) AS BIGINT) AS w FROM tagrows WHERE family = 'be_tags' GROUP BY user_id, tag",
                            O.EV, O.BEHAVIOR, O.BW, O.TAGROWS))(_map_zip_merge)
register("merge_interest_day", W("SELECT * FROM s2", *O.interest_ctes([DAY1, DAY2])))(
    lambda s, sf: _state(s, sf, [DAY1, DAY2]))
register("merge_interest_keep_stale", W(f"SELECT * FROM {LAST}", *O.interest_ctes(ALL_DAYS, "keep_stale")))(
    lambda s, sf: _full_state(s, sf, expire="keep_stale"))
register("merge_interest_decay_inactive", W(f"SELECT * FROM {LAST}", *O.interest_ctes(ALL_DAYS, decay_inactive=True)))(
    lambda s, sf: _full_state(s, sf, decay_inactive=True))
register("merge_interest_decay_param", W(f"SELECT * FROM {LAST}", *O.interest_ctes(ALL_DAYS, decay="0.995")))(
    lambda s, sf: _full_state(s, sf, decay=0.995))
register("merge_interest_3days", W("SELECT * FROM s3", *O.interest_ctes([DAY1, DAY2, DAY3])))(
    lambda s, sf: _state(s, sf, [DAY1, DAY2, DAY3]))
register("merge_interest_all_days", W(f"SELECT * FROM {LAST}", *O.interest_ctes(ALL_DAYS)))(_full_state)
register("interest_text", W(f"SELECT user_id, family, tag, CAST(weight AS VARCHAR) AS value FROM {LAST}",
                            *O.interest_ctes(ALL_DAYS)))(
    lambda s, sf: interest.interest_text(_full_state(s, sf)))

def _interest_deltas(s, sf):
    """The full state as the store keeps it: a base of all but the last days, and a delta of each of these by the daily job."""
    days, base = A.event_days(s, sf), scratch_folder(s, "interest-store")
    first = _state(s, sf, days[:-LATER]).select("user_id", "tag", "weight", "family", F.lit(False).alias("deleted"))
    S.interest_store(s, base, **LAYOUT).commit(days[-LATER - 1], None, first)
    for d in days[-LATER:]:
        jobs.interest_job(s, A.behavior(s, sf, d), base, d, **LAYOUT)
    return S.read_snapshot(s, base, days[-1], S.INTEREST_SCHEMA).select("user_id", "family", "tag", "weight")


register("interest_state_deltas", W(f"SELECT * FROM {LAST}", *O.interest_ctes(ALL_DAYS)))(_interest_deltas)

_KNOWN = ("SELECT DISTINCT d2.user_id FROM d2 JOIN (SELECT user_id FROM s1 GROUP BY user_id "
          "HAVING COUNT(DISTINCT family) = 2) h ON d2.user_id = h.user_id")
register("known_users", W(_KNOWN, *O.interest_ctes([DAY1, DAY2])))(
    lambda s, sf: interest.known_users(_state(s, sf, [DAY1]), _day(s, sf, DAY2)))
register("new_users", W("SELECT DISTINCT user_id FROM d2 WHERE user_id NOT IN (SELECT user_id FROM s1 "
                        "GROUP BY user_id HAVING COUNT(DISTINCT family) = 2)", *O.interest_ctes([DAY1, DAY2])))(
    lambda s, sf: interest.new_users(_state(s, sf, [DAY1]), _day(s, sf, DAY2)))

# --- key-set operations (yesterday's state vs today's keys, active users) -------------

_OLD_ACTIVE = "SELECT user_id, family, tag FROM s1 WHERE user_id IN (SELECT user_id FROM d2)"
_NEW = "SELECT user_id, family, tag FROM d2"
for _name, _body, _fn in [
    ("tags_intersect", f"{_OLD_ACTIVE} INTERSECT ALL {_NEW}", profile.tags_intersect),
    ("tags_lost", f"{_OLD_ACTIVE} EXCEPT ALL {_NEW}", profile.tags_lost),
    ("tags_gained", f"{_NEW} EXCEPT ALL ({_OLD_ACTIVE})", profile.tags_gained),
    ("tags_union", f"{_OLD_ACTIVE} UNION {_NEW}", profile.tags_union),
]:
    register(_name, W(_body, *O.interest_ctes([DAY1, DAY2])))(
        (lambda fn: lambda s, sf: fn(_state(s, sf, [DAY1]), _day(s, sf, DAY2)))(_fn))

# --- slots ----------------------------------------------------------------------------

register("slot_tag", W("SELECT user_id, dt, slot, n FROM srows", O.EV, O.BROWSE, O.SROWS))(
    lambda s, sf: slots.slot_rows(A.browse(s, sf)))
register("slot_counts", W("SELECT * FROM sstate", *O.SLOT_BASE, O.SLOT_STATE_ALL))(
    lambda s, sf: slots.daily_slots(A.browse(s, sf)))


def _slots_two_days(s, sf):
    st = slots.daily_slots(A.browse(s, sf, DAY1))
    return slots.merge_slots(st, slots.daily_slots(A.browse(s, sf, DAY2)))


register("merge_slots_day", W(
    "SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.slot, b.slot) AS slot, "
    "CAST(COALESCE(a.n, 0) + COALESCE(b.n, 0) AS BIGINT) AS n "
    f"FROM (SELECT user_id, slot, n FROM sdaily WHERE dt = '{DAY1}') a "
    f"FULL OUTER JOIN (SELECT user_id, slot, n FROM sdaily WHERE dt = '{DAY2}') b "
    "ON a.user_id = b.user_id AND a.slot = b.slot", *O.SLOT_BASE))(_slots_two_days)
def _slots_by_day(s, sf):
    return slots.numbered_days(slots.daily_slots(A.browse(s, sf), by_day=True))


register("slot_summary", W("SELECT * FROM ssum", *O.SLOT_BASE, O.SLOT_SUMMARY))(
    lambda s, sf: slots.history_summary(_slots_by_day(s, sf)))

register("slot_summary_all", W("SELECT * FROM ssum_all", *O.SLOT_BASE, O.SLOT_SUMMARY_ALL))(
    lambda s, sf: slots.history_summary(_slots_by_day(s, sf), summary="all"))


def _slot_stores(s, sf):
    """The slot and summary stores after all days: a base of all but the last days, and the daily job for each of these."""
    days, base, texts = A.event_days(s, sf), scratch_folder(s, "slot-store"), scratch_folder(s, "summary-store")
    before = A.browse(s, sf).where(F.col("dt") < days[-LATER])
    old = F.lit(False).alias("deleted")
    counts = slots.daily_slots(before).select("user_id", "slot", "n", old)
    S.slot_store(s, base, **LAYOUT).commit(days[-LATER - 1], None, counts)
    summaries = slots.history_summary(slots.numbered_days(slots.daily_slots(before, by_day=True)))
    S.summary_store(s, texts, **LAYOUT).commit(days[-LATER - 1], None, summaries.select("user_id", "summary", old))
    for d in days[-LATER:]:
        jobs.slots_job(s, A.browse(s, sf, d), base, texts, d, **LAYOUT)
    return base, texts, days[-1]


def _slot_deltas(s, sf):
    base, _, last = _slot_stores(s, sf)
    return S.read_snapshot(s, base, last, S.SLOT_SCHEMA)


def _summary_deltas(s, sf):
    _, texts, last = _slot_stores(s, sf)
    return S.read_snapshot(s, texts, last, S.SUMMARY_SCHEMA)


register("slot_state_deltas", W("SELECT * FROM sstate", *O.SLOT_BASE, O.SLOT_STATE_ALL))(_slot_deltas)
register("slot_summary_deltas", W("SELECT * FROM ssum", *O.SLOT_BASE, O.SLOT_SUMMARY))(_summary_deltas)

# --- similarity -----------------------------------------------------------------------

_SIM_SMALL = O.similarity_ctes(O.UI_SMALL)
_SIM_LARGE = O.similarity_ctes(O.UI_LARGE)
register("user_items", W(f"SELECT DISTINCT user_id, substr(tag, 6) AS item FROM {LAST} WHERE family = 'prod_tags'",
                         *O.interest_ctes(ALL_DAYS)))(
    lambda s, sf: push.user_items(_full_state(s, sf)))
register("item_frequency", W("SELECT item, n FROM freq", *_SIM_LARGE))(
    lambda s, sf: similarity.item_frequency(A.user_items_large(s, sf)))
register("item_cooccurrence", W("SELECT i AS item, j AS neighbour, c FROM pc UNION ALL "
                                "SELECT j AS item, i AS neighbour, c FROM pc", *_SIM_SMALL))(
    lambda s, sf: similarity.cooccurrence(A.user_items_small(s, sf)))
register("item_similarity", W("SELECT item, neighbour, score FROM sim", *_SIM_SMALL))(
    lambda s, sf: similarity.similarity(A.user_items_small(s, sf)))
_TOP = "SELECT item, neighbour, c, score, rank FROM top"
register("item_similarity_top6", W(_TOP, *_SIM_SMALL))(
    lambda s, sf: similarity.similarity_top_k(A.user_items_small(s, sf)))
register("item_similarity_top6_orders", W(_TOP, *_SIM_LARGE))(
    lambda s, sf: similarity.similarity_top_k(A.user_items_large(s, sf)))
# the same table with bounds so low that most users span several chunks and the larger ones are heavy:
# the paths that at scale only very large users take
register("item_similarity_top6_chunks", W(_TOP, *_SIM_LARGE))(
    lambda s, sf: similarity.similarity_top_k(A.user_items_large(s, sf), chunk_items=16))
register("item_similarity_top6_heavy", W(_TOP, *_SIM_LARGE))(
    lambda s, sf: similarity.similarity_top_k(A.user_items_large(s, sf), chunk_items=16, heavy_items=48))


def _kept_similarity(s, sf):
    """Top neighbours by the users' products, counts kept from day to day: all but the last days at once, then day by day."""
    days, base = A.event_days(s, sf), scratch_folder(s, "pair-store")
    state, before, prev = None, s.createDataFrame([], "user_id string, item string"), None
    for span in [days[:-LATER], *([d] for d in days[-LATER:])]:
        state = interest.replay_interest(A.behavior(s, sf, days=span), span, prev=state)
        state = cut_lineage(state, "interest-snapshot")
        items = push.user_items(state)
        pair_state.pair_job(s, base, span[-1], prev, before, items, **LAYOUT)
        before, prev = items, span[-1]
    return pair_state.kept_top_k(s, base, prev)


register("item_similarity_kept", W(_TOP, *O.interest_ctes(ALL_DAYS), *O.similarity_ctes(O.ui_state(LAST))))(_kept_similarity)

# --- push -----------------------------------------------------------------------------

for _seed, _order in (("max", "DESC"), ("min", "ASC")):
    register(f"seed_item_{_seed}", W("SELECT user_id, item, weight FROM seed",
                                     *O.interest_ctes(ALL_DAYS), O.seed_cte(_order, LAST)))(
        (lambda seed: lambda s, sf: push.seed_item(_full_state(s, sf), seed))(_seed))


def push_rows_two_days(s: SparkSession, sf: str) -> DataFrame:
    """The smoke case: push rows after the first two days."""
    return push.push_rows(cut_lineage(_state(s, sf, [DAY1, DAY2]), "interest-snapshot"), run_dt=DAY2)


def _push(s, sf, **options):
    """Push rows from the full profile, dated by its last day."""
    return push.push_rows(_snapshot(s, sf), run_dt=A.event_days(s, sf)[-1], **options)


def _push_sql(order: str = "DESC", body: str = "SELECT * FROM push") -> str:
    return W(body, *O.push_ctes(order, ALL_DAYS[-1], ALL_DAYS))


register("push_rows", _push_sql())(_push)
register("push_rows_all_days", _push_sql())(_push)  # its name before push_rows read the full profile
register("push_rows_two_days", W("SELECT * FROM push", *O.push_ctes("DESC")))(push_rows_two_days)
register("push_rows_seed_min", _push_sql("ASC"))(lambda s, sf: _push(s, sf, seed="min"))
register("push_rows_exclude_seen", _push_sql(body='SELECT * FROM push WHERE NOT EXISTS (SELECT 1 FROM ui '
                                             'WHERE ui.user_id = "MEMBER_ID" AND ui.item = "PROD_ID")'))(
    lambda s, sf: _push(s, sf, exclude_seen=True))
register("push_preview", _push_sql(body='SELECT * FROM push ORDER BY "MEMBER_ID", "PROD_ID" LIMIT 10'))(
    lambda s, sf: push.push_preview(_push(s, sf)))
register("push_lists", O.push_lists_sql("DESC", ALL_DAYS))(lambda s, sf: push.push_lists(_snapshot(s, sf)))

# --- profile snapshot (upsert of attribute tags over interest, slots and summary) ------

_PROFILE_SQL = W(
    "SELECT user_id, family, tag, value FROM prior p WHERE NOT EXISTS (SELECT 1 FROM basic_long b "
    "WHERE b.user_id = p.user_id AND b.family = p.family AND b.tag = p.tag) "
    "UNION ALL SELECT user_id, family, tag, value FROM basic_long",
    *O.interest_ctes(ALL_DAYS), O.BROWSE, O.SROWS, O.SDAILY, O.SLOT_SUMMARY, O.SLOT_STATE_ALL,
    *MB, O.BASIC, O.BASIC_LONG,
    f"""prior AS (
  SELECT user_id, family, tag, CAST(weight AS VARCHAR) AS value FROM {LAST}
  UNION ALL SELECT user_id, 'time_tags', slot, {O.dbl_text('n')} FROM sstate
  UNION ALL SELECT user_id, 'user_tags', 'time_tags', summary FROM ssum)""")


def _profile(s, sf):
    cells = cut_lineage(slots.history_cells(_slots_by_day(s, sf)), "slot-cells")  # read as counts and as summary
    prior = (profile.interest_cells(_full_state(s, sf))
             .unionByName(profile.slot_cells(cells))
             .unionByName(profile.summary_cells(slots.summary_of_cells(cells))))
    return profile.upsert(prior, profile.basic_tags_long(_member(s, sf), as_of=AS_OF), families=(profile.ATTRIBUTE_FAMILY,))


register("profile_upsert", _PROFILE_SQL)(_profile)


def _cell_deltas(s, sf):
    """The attribute cells of two runs with half a year between them: the second writes the ages that changed."""
    base = scratch_folder(s, "cell-store")
    for d, as_of in ((DAY1, "2018-01-15"), (DAY2, AS_OF)):
        jobs.basic_tags_job(s, A.member(s, sf, d), base, d, as_of=as_of, **LAYOUT)
    return S.read_snapshot(s, base, DAY2, S.CELL_SCHEMA).select("user_id", "family", "tag", "value")


register("profile_cells_deltas", W("SELECT * FROM basic_long", *MB, O.BASIC, O.BASIC_LONG))(_cell_deltas)

# --- enrichment and JSON --------------------------------------------------------------

register("ip_geo_enrich", W("SELECT p.id, p.ip, r.region, r.city, r.isp FROM probe p "
                            "LEFT JOIN ranges r ON p.ip BETWEEN r.lo AND r.hi", O.IP))(
    lambda s, sf: enrich.ip_enrich(A.ip_probe(s, sf), A.ip_ranges(s, sf)))


def _nested_ranges(s, sf):
    """Ranges that overlap: every address, each region's span, each nation's block, a narrow one inside it and one across its end."""
    blocks = A.ip_ranges(s, sf)
    named = blocks.select("lo", "hi", "region", "city", "isp")
    world = named.agg(F.lit(0).cast("bigint").alias("lo"), F.lit(2**32 - 1).cast("bigint").alias("hi"), F.lit("world").alias("region"),
                      F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("isp"))
    spans = named.groupBy("region").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        "lo", "hi", "region", F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("isp"))
    inner = named.select((F.col("lo") + 1000001).alias("lo"), (F.col("lo") + 90000077).alias("hi"), "region", F.concat("city", F.lit(" centre")).alias("city"), "isp")
    across = named.select((F.col("hi") - 3000003).alias("lo"), (F.col("hi") + 3000010).alias("hi"), "region", F.concat("city", F.lit(" border")).alias("city"), "isp")
    return world.unionByName(spans).unionByName(named).unionByName(inner).unionByName(across)


register("ip_geo_most_specific", W(
    "SELECT id, ip, region, city, isp FROM (SELECT p.id, p.ip, r.region, r.city, r.isp, ROW_NUMBER() OVER (PARTITION BY p.id "
    "ORDER BY r.hi - r.lo, r.lo, r.region NULLS FIRST, r.city NULLS FIRST, r.isp NULLS FIRST) AS rn "
    "FROM probe p LEFT JOIN nested r ON p.ip BETWEEN r.lo AND r.hi) x WHERE rn = 1", O.IP, O.NESTED))(
    lambda s, sf: enrich.ip_most_specific(A.ip_probe(s, sf), _nested_ranges(s, sf)))


def _ip_json(s, sf):
    enriched = enrich.ip_enrich(A.ip_probe(s, sf), A.ip_ranges(s, sf))
    doc = J.encode(F.lit(0).alias("code"), F.struct("region", "city", "isp").alias("data"))
    parsed = enriched.select("id", doc.alias("doc"))
    return parsed.select("id", *[J.field("doc", f"$.data.{k}").alias(k) for k in ("region", "city", "isp")])


register("ip_geo_json", W("SELECT p.id, r.region, r.city, r.isp FROM probe p "
                          "LEFT JOIN ranges r ON p.ip BETWEEN r.lo AND r.hi", O.IP))(_ip_json)
register("json_field", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")(
    lambda s, sf: table(s, sf, "events").select("event_id", J.field("props", "$.k").try_cast("int").alias("k")))
register("json_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")(
    lambda s, sf: table(s, sf, "events").select("event_id", J.decode("props", "k int")["k"].alias("k")))
register("json_encode", "SELECT event_id, to_json({'user_id': user_id, 'event_type': event_type, "
                        "'k': TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)}) AS doc FROM events")(
    lambda s, sf: table(s, sf, "events").select(
        "event_id", J.encode(F.col("user_id"), F.col("event_type"), A.props_k().alias("k")).alias("doc")))


def _json_pretty(s, sf):
    """Pretty-printed records, read back by path; the number of lines shows the layout."""
    doc = J.encode(F.col("user_id"), F.col("event_type"), A.props_k().alias("k"), pretty=True)
    rows = table(s, sf, "events").select("event_id", doc.alias("doc"))
    return rows.select("event_id", J.field("doc", "$.user_id").cast("bigint").alias("user_id"),
                       J.field("doc", "$.event_type").alias("event_type"), J.field("doc", "$.k").cast("int").alias("k"),
                       F.size(F.split("doc", "\n")).alias("n_lines"))


register("json_encode_pretty", "SELECT event_id, CAST(user_id AS BIGINT) AS user_id, event_type, k, "
                               "CAST(4 + (k IS NOT NULL)::INT AS INTEGER) AS n_lines FROM (SELECT *, "
                               "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e")(_json_pretty)
register("json_map", "SELECT e.event_id, j.key AS key, json_extract_string(e.props, '$.\"' || j.key || '\"') "
                     "AS value FROM events e, json_each(e.props) j")(
    lambda s, sf: table(s, sf, "events").select("event_id", F.explode(J.decode_map("props")).alias("key", "value")))


def _push_json(s, sf):
    cand = push.push_candidates(_snapshot(s, sf))
    rec = F.array_sort(F.collect_list(F.struct("rank", F.col("neighbour").alias("prod_id"))))
    return cand.groupBy("user_id").agg(J.encode_array(rec).alias("doc"))


register("json_array_encode", _push_sql(body="SELECT user_id, to_json(list({'rank': rank, 'prod_id': neighbour} ORDER BY rank)) "
                                        "AS doc FROM cand GROUP BY user_id"))(_push_json)
register("json_array_explode", _push_sql(body="SELECT user_id, rank, neighbour AS prod_id FROM cand"))(
    lambda s, sf: _push_json(s, sf).select("user_id", F.inline(J.decode_array("doc", "rank:int,prod_id:string"))))


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
