"""Input views of the profile jobs over the driver's tables (see FIXTURES.md section 2).

member   <- customer x nation x region         (one daily snapshot, every member)
behavior <- events                              (daily partition = day of ts)
browse   <- events
user-item small <- distinct (user_id, k) of events; large <- orders x lineitem
ip probe / ip ranges <- events / nation x region
All rules are deterministic column expressions so that Spark and DuckDB agree.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# Fixed values of the adapters (FIXTURES.md section 2).
CITY_TIERS = {0: "一线城市", 1: "二线城市", 2: "三线城市", 3: "四线城市"}  # c_nationkey % 5; 4 -> NULL
IP_RANGE_WIDTH = 171798691
IP_HASH_MULT = 2654435761
IP_SPACE = 4294967296
DEFAULT_MEMBER_DT = "20240101"


def parse_dt(dt: str) -> _dt.date:
    """A partition date 'yyyyMMdd' or ISO 'yyyy-MM-dd' (never spliced into SQL text)."""
    s = str(dt)
    if len(s) == 8 and s.isdigit():
        return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:]))
    return _dt.date.fromisoformat(s)


def dt_key(dt: str) -> str:
    return parse_dt(dt).strftime("%Y%m%d")


def _ts_day_filter(ts: Column, dt: str) -> Column:
    """ts within the day ``dt``: a range predicate the parquet scan can push down."""
    d = parse_dt(dt)
    lo = F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")
    hi = F.lit((d + _dt.timedelta(days=1)).isoformat() + " 00:00:00").cast("timestamp_ntz")
    return (ts >= lo) & (ts < hi)


def props_k(c="props") -> Column:
    return F.get_json_object(F.col(c), "$.k").try_cast("int")


def member(spark: SparkSession, sf_dir: str, dt: str = DEFAULT_MEMBER_DT) -> DataFrame:
    """Member snapshot for partition ``dt`` (every customer is present in every snapshot)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    c = F.col("c_custkey")
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    birth = (F.when(c % 97 == 0, F.lit(None).cast("string"))
             .when(c % 89 == 0, F.lit("2001-5"))
             .when(c % 83 == 0, F.lit("19"))
             .otherwise(F.concat_ws("-", pad(F.lit(1940) + c % 80, 4), pad(F.lit(1) + c % 12, 2),
                                    pad(F.lit(1) + c % 28, 2))))
    gender = (F.when(c % 4 == 0, F.lit(0)).when(c % 4 == 1, F.lit(1))
              .when(c % 4 == 2, F.lit(None).cast("int")).otherwise(F.lit(7)))
    seg = F.col("c_mktsegment")
    position = F.when(c % 10 == 0, F.lit("")).when(c % 10 == 1, F.lit(None).cast("string")).otherwise(seg)
    hobby = F.when(c % 7 == 0, F.lit("")).when(c % 7 == 1, F.lit(None).cast("string")).otherwise(seg)
    nk = F.col("c_nationkey") % 5
    tier = F.lit(None).cast("string")
    for k in sorted(CITY_TIERS, reverse=True):
        tier = F.when(nk == k, F.lit(CITY_TIERS[k])).otherwise(tier)
    return (cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(c.cast("string").alias("id"),
                    gender.alias("gender"),
                    birth.alias("birth"),
                    (c % 6).cast("int").alias("deformity_level"),
                    (c % 11).cast("int").alias("education_level"),
                    position.alias("position"),
                    hobby.alias("hobby"),
                    (c % 5).cast("int").alias("terminal_type"),
                    F.col("r_name").alias("province"),
                    F.col("n_name").alias("city"),
                    tier.alias("city_level"),
                    F.lit(dt_key(dt)).alias("dt")))


def _days_filter(ts: Column, days: list[str]) -> Column:
    """ts within [first day, last day + 1): a range the scan can push down (exact day set applied after)."""
    ds = sorted(parse_dt(d) for d in days)
    lo = F.lit(ds[0].isoformat() + " 00:00:00").cast("timestamp_ntz")
    hi = F.lit((ds[-1] + _dt.timedelta(days=1)).isoformat() + " 00:00:00").cast("timestamp_ntz")
    return (ts >= lo) & (ts < hi)


def _events(spark: SparkSession, sf_dir: str, dt: str | None, cols: list[str],
            days: list[str] | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(*cols)
    if dt is not None:
        ev = ev.where(_ts_day_filter(F.col("ts"), dt))
    if days:
        ev = ev.where(_days_filter(F.col("ts"), days))
    return ev


def behavior(spark: SparkSession, sf_dir: str, dt: str | None = None, days: list[str] | None = None) -> DataFrame:
    """Behaviour rows (id, type_id, prod_id, behavior_id, dt); one day when ``dt`` is
    given, the span of ``days`` (pushed to the scan as a ts range) when that is given."""
    ev = _events(spark, sf_dir, dt, ["event_id", "ts", "user_id", "props"], days)
    e, k = F.col("event_id"), props_k()
    type_id = (F.when(e % 50 == 0, F.lit("")).when(e % 47 == 0, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("t"), (k % 20).cast("string"))))
    prod_id = F.when(e % 61 == 0, F.lit(None).cast("string")).otherwise(k.cast("string"))
    behavior_id = F.when(e % 59 == 0, F.lit(None).cast("string")).otherwise((e % 9).cast("string"))
    return ev.select(F.col("user_id").cast("string").alias("id"), type_id.alias("type_id"),
                     prod_id.alias("prod_id"), behavior_id.alias("behavior_id"),
                     F.date_format("ts", "yyyyMMdd").alias("dt"))


def browse(spark: SparkSession, sf_dir: str, dt: str | None = None) -> DataFrame:
    """Browse rows (id, browse_time, dt); browse_time is 'yyyy-MM-dd HH:mm:ss' text."""
    ev = _events(spark, sf_dir, dt, ["event_id", "ts", "user_id"])
    e = F.col("event_id")
    bt = F.when(e % 53 == 0, F.lit(None).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ev.select(F.col("user_id").cast("string").alias("id"), bt.alias("browse_time"),
                     F.date_format("ts", "yyyyMMdd").alias("dt"))


def event_days(spark: SparkSession, sf_dir: str) -> list[str]:
    """Daily partitions present in events (a calendar-bounded list, not data-sized)."""
    rows = (table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("dt"))
            .distinct().orderBy("dt").collect())
    return [r.dt for r in rows]


def of_latest_day(daily_table: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows of a dt-partitioned table of the last day that ``loads`` has: a subquery whose result prunes the partitions when the query runs."""
    return daily_table.where(F.col("dt") == loads.agg(F.max("dt")).scalar())


def user_items_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (user_id, item) with item = $.k of events.props."""
    ev = table(spark, sf_dir, "events").select("user_id", "props")
    k = props_k()
    return (ev.where(k.isNotNull())
            .select(F.col("user_id").cast("string").alias("user_id"), k.cast("string").alias("item"))
            .distinct())


def user_items_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer, part) bought, from orders x lineitem."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("l_partkey").cast("string").alias("item"))
            .distinct())


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP range dimension (lo, hi, region, city, isp): one block of addresses per nation."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nk = F.col("n_nationkey").cast("bigint")
    return (n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select((nk * IP_RANGE_WIDTH).alias("lo"), ((nk + 1) * IP_RANGE_WIDTH - 1).alias("hi"),
                    F.col("r_name").alias("region"), F.col("n_name").alias("city"),
                    F.concat(F.lit("isp"), F.col("n_regionkey").cast("string")).alias("isp")))


def ip_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ip) per event; ip is a 32-bit value spread by a multiplicative hash."""
    ev = table(spark, sf_dir, "events").select("event_id")
    ip = (F.col("event_id").cast("decimal(38,0)") * F.lit(IP_HASH_MULT)) % F.lit(IP_SPACE)
    return ev.select(F.col("event_id").alias("id"), ip.cast("bigint").alias("ip"))
