"""Edge rows of the attribute, behaviour and slot rules (FIXTURES section 3)."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import rules as R
from tagloom.operators import profile


def _one(spark, schema, rows, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_gender_codes(spark):
    rows = [(0,), (1,), (None,), (7,)]
    assert _one(spark, "g int", rows, R.gender_tag("g")) == ["001001", "001002", "unknown", "unknown"]
    assert _one(spark, "g int", rows, R.gender_tag("g", null_int_as_zero=True)) == [
        "001001", "001002", "001001", "unknown"]


def test_terminal_deformity_education(spark):
    assert _one(spark, "t int", [(0,), (3,), (4,), (None,)], R.terminal_tag("t")) == [
        "005001", "005004", "unknown", "unknown"]
    assert _one(spark, "t int", [(None,)], R.terminal_tag("t", null_int_as_zero=True)) == ["005001"]
    assert _one(spark, "d int", [(0,), (1,), (4,), (5,), (None,)], R.deformity_tag("d")) == [
        "unknown", "009001", "009004", "unknown", "unknown"]
    assert _one(spark, "e int", [(0,), (1,), (9,), (10,)], R.education_tag("e")) == [
        "unknown", "003001", "003009", "unknown"]


@pytest.mark.parametrize("birth,calendar,reference", [
    (None, "002001", "002001"),          # NULL -> age 0
    ("19", "002001", "002001"),          # shorter than 4 -> age 0
    ("2001-5", "unknown", "unknown"),    # day slice not a number
    ("2003-07-15", "002002", "002002"),  # birthday: 15
    ("2003-07-16", "002001", "002001"),  # day before birthday: 14
    ("2003-07-14", "002002", "002001"),  # day after: 15 (14 under the reference rule)
    ("1957-07-15", "002006", "002006"),  # 61
    ("1958-07-15", "002005", "002005"),  # 60
    ("abcd-07-15", "unknown", "unknown"),
])
def test_age_bands(spark, birth, calendar, reference):
    df = spark.createDataFrame([(birth,)], "b string")
    got = df.select(R.age_tag("b", "2018-07-15").alias("c"),
                    R.age_tag("b", "2018-07-15", rule="reference").alias("r")).first()
    assert (got.c, got.r) == (calendar, reference)


def test_missing_birth_option(spark):
    df = spark.createDataFrame([(None,), ("19",)], "b string")
    assert [r[0] for r in df.select(R.age_tag("b", "2018-07-15", missing_birth="unknown")).collect()] == [
        "unknown", "unknown"]


def test_text_rules_do_not_trim(spark):
    assert _one(spark, "p string", [("",), (None,), (" ",), ("x",)], R.text_or_unknown("p")) == [
        "unknown", "unknown", " ", "x"]


def test_city_level_fallbacks(spark):
    rows = [("一线城市",), ("三线城市",), ("四线城市",), (None,)]
    assert _one(spark, "c string", rows, R.city_level_tag("c")) == ["007001", "007003", "unknown", "unknown"]
    assert _one(spark, "c string", rows, R.city_level_tag("c", R.UNKNOWN_LOCATION)) == [
        "007001", "007003", "未知", "未知"]


def test_behaviour_weight(spark):
    rows = [("0",), ("7",), ("8",), (None,), ("x",)]
    assert _one(spark, "b string", rows, R.behaviour_weight("b")) == [8, 1, 0, 0, 0]


@pytest.mark.parametrize("hour,slot", [(4, "015005"), (5, "015001"), (8, "015002"), (11, "015003"),
                                       (13, "015004"), (18, "015005"), (23, "015005"), (0, "015005")])
def test_slots(spark, hour, slot):
    t = f"2018-07-29 {hour:02d}:14:23.0"
    assert _one(spark, "t string", [(t,)], R.slot_of_hour(R.hour_of("t"))) == [slot]


def test_slot_missing_or_bad_time(spark):
    rows = [(None,), ("2018-07-29",), ("2018-07-29 25:00:00",)]
    slots = _one(spark, "t string", rows, R.slot_of_hour(R.hour_of("t")))
    assert slots == ["time_tags"] * 3


def test_java_double_text(spark):
    rows = [(0,), (3,), (9999999,), (10000000,), (12345678,), (100000000000,)]
    assert _one(spark, "n bigint", rows, R.java_double_text(F.col("n"))) == [
        "0.0", "3.0", "9999999.0", "1.0E7", "1.2345678E7", "1.0E11"]


def test_basic_tags_long_has_ten_cells(spark):
    m = spark.createDataFrame(
        [("u1", 0, "2003-07-15", 1, 2, "", None, 0, "P", "C", "二线城市")],
        "id string, gender int, birth string, deformity_level int, education_level int, position string, "
        "hobby string, terminal_type int, province string, city string, city_level string")
    cells = {r.tag: r.value for r in profile.basic_tags_long(m, as_of="2018-07-15").collect()}
    assert cells == {"gender": "001001", "age": "002002", "deformity_level": "009001",
                     "education_level": "003002", "position": "unknown", "hobby": "unknown",
                     "terminal_type": "005001", "province": "P", "city": "C", "city_level": "007002"}
    loc = profile.location_tags(m.withColumn("province", F.lit(None).cast("string"))).first()
    assert loc.province is None and loc.city == "C" and loc.city_level == "007002"
