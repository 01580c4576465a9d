"""Profile upsert, IP-range enrichment against brute force, JSON conversions."""

import json
import random

from pyspark.sql import functions as F

from tagloom.functions import jsonfn as J
from tagloom.operators import enrich, profile


def test_upsert_keeps_unwritten_cells(spark):
    old = spark.createDataFrame([("u", "user_tags", "time_tags", "List((015001,1.0))"),
                                 ("u", "user_tags", "gender", "001002")],
                                "user_id string, family string, tag string, value string")
    new = spark.createDataFrame([("u", "user_tags", "gender", "001001")],
                                "user_id string, family string, tag string, value string")
    got = {(r.tag, r.value) for r in profile.upsert(old, new).collect()}
    assert got == {("time_tags", "List((015001,1.0))"), ("gender", "001001")}
    twice = {(r.tag, r.value) for r in profile.upsert(profile.upsert(old, new), new).collect()}
    assert twice == got


def test_set_operations(spark):
    prev = spark.createDataFrame([("u", "be_tags", "a"), ("u", "be_tags", "b"), ("x", "be_tags", "q")],
                                 "user_id string, family string, tag string")
    daily = spark.createDataFrame([("u", "be_tags", "b"), ("u", "be_tags", "c")],
                                  "user_id string, family string, tag string")
    tags = lambda df: sorted(r.tag for r in df.collect())
    assert tags(profile.tags_intersect(prev, daily)) == ["b"]
    assert tags(profile.tags_lost(prev, daily)) == ["a"]
    assert tags(profile.tags_gained(prev, daily)) == ["c"]
    assert tags(profile.tags_union(prev, daily)) == ["a", "b", "c"]


def test_ip_range_join_matches_brute_force(spark):
    rnd = random.Random(11)
    bounds = sorted(rnd.sample(range(1, 2 ** 32 - 1), 40))
    ranges = [(bounds[i], bounds[i + 1] - 1, f"r{i}", f"c{i}", "isp") for i in range(0, 38, 2)]
    probes = [(i, rnd.randrange(2 ** 32)) for i in range(400)]
    probes += [(1000 + i, lo) for i, (lo, *_r) in enumerate(ranges)]    # exact lower bounds
    probes += [(2000 + i, hi) for i, (_l, hi, *_r) in enumerate(ranges)]  # exact upper bounds
    r_df = spark.createDataFrame(ranges, "lo bigint, hi bigint, region string, city string, isp string")
    p_df = spark.createDataFrame(probes, "id bigint, ip bigint")
    for bits, threshold in ((16, "10m"), (24, "10m"), (16, "-1")):  # broadcast and shuffled dimension
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = {(r.id, r.city) for r in enrich.ip_enrich(p_df, r_df, bits).collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        want = set()
        for pid, ip in probes:
            hit = [c for lo, hi, _r, c, _i in ranges if lo <= ip <= hi]
            want.add((pid, hit[0] if hit else None))
        assert got == want, bits


def test_json_record_and_array_round_trip(spark):
    df = spark.createDataFrame([("xiaoD", 11)], "name string, age int")
    doc = df.select(J.encode(F.col("name"), F.col("age")).alias("d")).first().d
    assert json.loads(doc) == {"name": "xiaoD", "age": 11}
    back = spark.createDataFrame([(doc,)], "d string").select(J.decode("d", "name string, age int").alias("s"))
    assert tuple(back.first().s) == ("xiaoD", 11)
    students = spark.range(5).select(F.concat(F.lit("student"), F.col("id").cast("string")).alias("name"),
                                     F.col("id").cast("int").alias("age"))
    arr = students.agg(J.encode_array(F.array_sort(F.collect_list(F.struct("age", "name")))).alias("a")).first().a
    assert [s["name"] for s in json.loads(arr)] == [f"student{i}" for i in range(5)]
    rows = (spark.createDataFrame([(arr,)], "a string")
            .select(F.inline(J.decode_array("a", "age:int,name:string"))).orderBy("age").collect())
    assert [(r.age, r.name) for r in rows] == [(i, f"student{i}") for i in range(5)]
    m = spark.createDataFrame([('{"data": {"region": "R", "city": "C", "isp": "I"}}',)], "d string")
    assert m.select(J.field("d", "$.data.city")).first()[0] == "C"
    inner = m.select(J.decode_map(J.field("d", "$.data")).alias("m")).first().m
    assert inner == {"region": "R", "city": "C", "isp": "I"}


def test_ip_range_join_overlapping_ranges(spark):
    rnd = random.Random(5)
    ranges = []
    for i in range(30):
        lo = rnd.randrange(0, 2 ** 32 - 2 ** 20)
        ranges.append((lo, lo + rnd.randrange(1, 2 ** 20), f"r{i}", f"c{i}", "isp"))
    probes = [(i, rnd.randrange(2 ** 32)) for i in range(300)] + [(1000 + i, lo) for i, (lo, *_r) in enumerate(ranges)]
    r_df = spark.createDataFrame(ranges, "lo bigint, hi bigint, region string, city string, isp string")
    p_df = spark.createDataFrame(probes, "id bigint, ip bigint")
    got = sorted((r.id, r.city or "") for r in enrich.ip_enrich(p_df, r_df).collect())
    want = []
    for pid, ip in probes:
        hits = [c for lo, hi, _r, c, _i in ranges if lo <= ip <= hi]
        want += [(pid, c) for c in hits] or [(pid, "")]
    assert got == sorted(want)


def test_checkpoint_folder_required_on_a_cluster():
    import pytest

    from tagloom.session import ensure_checkpoint_dir

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):  # noqa: N802 - mirrors the SparkContext method
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session())


def test_prefixes_make_up_each_range(spark):
    rnd = random.Random(3)
    ranges = [(0, 2 ** 32 - 1), (0, 0), (5, 4), (None, 3), (2 ** 32 - 1, 2 ** 32 - 1), (1, 2 ** 32 - 2), (-5, 9), (2 ** 32 - 4, 2 ** 33)]
    ranges += [tuple(sorted((rnd.randrange(2 ** 32), rnd.randrange(2 ** 32)))) for _ in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "id int, lo bigint, hi bigint")
    blocks = {}
    for r in enrich.prefixes(df).collect():
        blocks.setdefault(r.id, []).append((r.prefix << r.k, (r.prefix + 1 << r.k) - 1, r.k))
    for i, (lo, hi) in enumerate(ranges):
        got = sorted(blocks.get(i, []))
        if lo is None or lo > hi:
            assert got == []
            continue
        assert got[0][0] == max(lo, 0) and got[-1][1] == min(hi, 2 ** 32 - 1) and len(got) <= 62
        assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))


def test_most_specific_range_matches_brute_force(spark):
    """Nested, crossing, equal and all-covering ranges; repeated and null probes; both joins of the blocks."""
    rnd = random.Random(12)
    ranges = [(0, 2 ** 32 - 1, None, "all", None)]
    for n in range(60):
        lo = rnd.randrange(2 ** 32)
        ranges.append((lo, min(2 ** 32 - 1, lo + rnd.choice([0, 7, 300, 70000, 2 ** 28])), f"r{n}", rnd.choice([None, f"c{n}"]), "isp"))
        if n % 3 == 0:
            ranges.append((lo, lo + 300, f"r{n}", f"in{n}", "isp"))
    ranges += ranges[5:8]
    edges = [x for lo, hi, *_ in ranges for x in (lo, hi, hi + 1)]
    probes = [(i, ip) for i, ip in enumerate([rnd.randrange(2 ** 32) for _ in range(200)] + edges)] + [(0, None), (0, None), (None, 5), (3, 77), (3, 78)]
    p_df = spark.createDataFrame(probes, "id bigint, ip bigint")

    def brute(ip, from_):
        key = lambda r: (r[1] - r[0], r[0], *[x for c in r[2:] for x in (c is not None, c or "")])
        hits = [r for r in ranges[from_:] if ip is not None and r[0] <= ip <= r[1]]
        return min(hits, key=key)[2:] if hits else (None, None, None)

    for from_, threshold in ((0, "10m"), (1, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            r_df = spark.createDataFrame(ranges[from_:], "lo bigint, hi bigint, region string, city string, isp string")
            got = sorted(map(tuple, enrich.ip_most_specific(p_df, r_df).collect()), key=str)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == sorted(((i, ip, *brute(ip, from_)) for i, ip in probes), key=str)
    none = enrich.ip_most_specific(p_df, r_df.limit(0)).collect()
    assert len(none) == len(probes) and all(r.region is None for r in none)
