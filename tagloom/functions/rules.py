"""Tag rules as Column expressions (no UDFs): attribute codes, age, behaviour weights, time slots."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The tag code book. These must equal the reference's codes.
# ---------------------------------------------------------------------------
UNKNOWN = "unknown"
UNKNOWN_LOCATION = "未知"  # fallback of the location rule set for the city tier
GENDER_CODES = {0: "001001", 1: "001002"}
AGE_BANDS = [  # (lowest age, highest age, code); open ends are None
    (None, 14, "002001"),
    (15, 27, "002002"),
    (28, 34, "002003"),
    (35, 44, "002004"),
    (45, 60, "002005"),
    (61, None, "002006"),
]
EDUCATION_CODES = {1: "003001", 2: "003002", 3: "003003", 4: "003004", 5: "003005",
                   6: "003006", 7: "003007", 8: "003008", 9: "003009"}
TERMINAL_CODES = {0: "005001", 1: "005002", 2: "005003", 3: "005004"}
CITY_LEVEL_CODES = {"一线城市": "007001", "二线城市": "007002", "三线城市": "007003"}
DEFORMITY_CODES = {1: "009001", 2: "009002", 3: "009003", 4: "009004"}
# hour ranges [lo, hi) -> slot code; 0-4 wraps into the evening slot
SLOT_RANGES = [(5, 8, "015001"), (8, 11, "015002"), (11, 13, "015003"), (13, 18, "015004"),
               (18, 24, "015005"), (0, 5, "015005")]
NO_TIME_SLOT = "time_tags"  # pseudo slot for a missing browse time, counted 0
BEHAVIOUR_WEIGHTS = {"0": 8, "1": 7, "2": 6, "3": 5, "4": 4, "5": 3, "6": 2, "7": 1}
BLANK_TYPE_TAG = "type_id"  # pseudo type tag for a blank type, weight 0
PRODUCT_PREFIX = "prod_"
DECAY = 0.75
THRESHOLD = 0.5
TOP_K = 6
# ---------------------------------------------------------------------------

BASIC_ATTRIBUTES = ["gender", "age", "deformity_level", "education_level", "position", "hobby",
                    "terminal_type", "province", "city", "city_level"]


def _code_map(col: Column, codes: dict, default: Column | None = None) -> Column:
    """CASE col WHEN k THEN v ... ELSE default (NULL falls to default)."""
    default = F.lit(UNKNOWN) if default is None else default
    items = list(codes.items())
    expr = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(default)


def _int_attr(c: str | Column, null_int_as_zero: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(0)) if null_int_as_zero else col


def gender_tag(c="gender", null_int_as_zero: bool = False) -> Column:
    return _code_map(_int_attr(c, null_int_as_zero), GENDER_CODES)


def deformity_tag(c="deformity_level", null_int_as_zero: bool = False) -> Column:
    return _code_map(_int_attr(c, null_int_as_zero), DEFORMITY_CODES)


def education_tag(c="education_level", null_int_as_zero: bool = False) -> Column:
    return _code_map(_int_attr(c, null_int_as_zero), EDUCATION_CODES)


def terminal_tag(c="terminal_type", null_int_as_zero: bool = False) -> Column:
    return _code_map(_int_attr(c, null_int_as_zero), TERMINAL_CODES)


def text_or_unknown(c: str | Column) -> Column:
    """Blank or NULL text -> 'unknown'; no trimming (a single space is kept)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull() | (col == F.lit("")), F.lit(UNKNOWN)).otherwise(col)


def city_level_tag(c="city_level", fallback: str = UNKNOWN) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return _code_map(col, CITY_LEVEL_CODES, F.lit(fallback))


def _as_of_parts(as_of):
    if as_of is None:
        d = F.current_date()
        return F.year(d), F.month(d), F.dayofmonth(d)
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of.year), F.lit(as_of.month), F.lit(as_of.day)


def age_years(c="birth", as_of=None, rule: str = "calendar") -> Column:
    """Age in whole years from a 'yyyy-MM-dd' string.

    NULL or fewer than 4 characters -> 0 (kept from the reference); any of the
    year/month/day slices not an integer -> NULL. ``rule='calendar'`` subtracts
    one before the birthday; ``rule='reference'`` subtracts one on every day of
    the birth month except the birthday itself.
    """
    b = F.col(c) if isinstance(c, str) else c
    cy, cm, cd = _as_of_parts(as_of)
    by = F.substring(b, 1, 4).try_cast("int")
    bm = F.substring(b, 6, 2).try_cast("int")
    bd = F.substring(b, 9, 2).try_cast("int")
    years = cy - by
    if rule == "calendar":
        before = (cm < bm) | ((cm == bm) & (cd < bd))
    elif rule == "reference":
        before = (cm < bm) | ((cm == bm) & (cd != bd))
    else:
        raise ValueError(f"unknown age rule {rule!r}")
    parsed = F.when(by.isNull() | bm.isNull() | bd.isNull(), F.lit(None).cast("int")).otherwise(
        years - F.when(before, 1).otherwise(0))
    return F.when(b.isNull() | (F.length(b) < 4), F.lit(0)).otherwise(parsed)


def age_band(age: Column) -> Column:
    expr = None
    for lo, hi, code in AGE_BANDS:
        cond = None
        if lo is not None:
            cond = age >= lo
        if hi is not None:
            cond = (age <= hi) if cond is None else (cond & (age <= hi))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(UNKNOWN))


def age_tag(c="birth", as_of=None, rule: str = "calendar", missing_birth: str = "zero") -> Column:
    band = age_band(age_years(c, as_of, rule))
    if missing_birth == "unknown":
        b = F.col(c) if isinstance(c, str) else c
        return F.when(b.isNull() | (F.length(b) < 4), F.lit(UNKNOWN)).otherwise(band)
    return band


def behaviour_weight(c="behavior_id") -> Column:
    """'0'..'7' -> 8..1; anything else (incl. NULL) -> 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(*BEHAVIOUR_WEIGHTS.keys()), F.lit(8) - col.cast("int")).otherwise(F.lit(0))


def is_blank(col: Column) -> Column:
    return col.isNull() | (col == F.lit(""))


def hour_of(c="browse_time") -> Column:
    """Hour from characters 12-13 of a timestamp string; NULL when not an integer."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col, 12, 2).try_cast("int")


def slot_of_hour(hour: Column) -> Column:
    """Hour -> slot code; NULL or out-of-range hour -> the pseudo slot."""
    expr = None
    for lo, hi, code in SLOT_RANGES:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(NO_TIME_SLOT))


def slot_weight(slot: Column) -> Column:
    return F.when(slot == F.lit(NO_TIME_SLOT), F.lit(0)).otherwise(F.lit(1))


def basic_tag_columns(as_of=None, rule: str = "calendar", null_int_as_zero: bool = False,
                      missing_birth: str = "zero") -> dict[str, Column]:
    """The ten attribute rules of the basic rule set, by tag name."""
    return {
        "gender": gender_tag("gender", null_int_as_zero),
        "age": age_tag("birth", as_of, rule, missing_birth),
        "deformity_level": deformity_tag("deformity_level", null_int_as_zero),
        "education_level": education_tag("education_level", null_int_as_zero),
        "position": text_or_unknown("position"),
        "hobby": text_or_unknown("hobby"),
        "terminal_type": terminal_tag("terminal_type", null_int_as_zero),
        "province": text_or_unknown("province"),
        "city": text_or_unknown("city"),
        "city_level": city_level_tag("city_level"),
    }


def location_tag_columns() -> dict[str, Column]:
    """The location rule set: province and city passed through, tier with its own fallback."""
    return {
        "province": F.col("province"),
        "city": F.col("city"),
        "city_level": city_level_tag("city_level", UNKNOWN_LOCATION),
    }


def java_double_text(n: Column) -> Column:
    """Text of a non-negative whole count as the JVM prints a double ('3.0', '1.2345E7')."""
    s = n.cast("bigint").cast("string")
    mant = F.regexp_replace(F.substring(s, 2, 64), "0+$", "")
    sci = F.concat(F.substring(s, 1, 1), F.lit("."),
                   F.when(mant == "", F.lit("0")).otherwise(mant), F.lit("E"),
                   (F.length(s) - 1).cast("string"))
    return F.when(n < F.lit(10_000_000), F.concat(s, F.lit(".0"))).otherwise(sci)
