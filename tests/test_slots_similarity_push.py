"""Slots, similarity and push: hand-written cases plus brute-force checks on small fixtures."""

import itertools
import math
import random

import pytest

from tagloom.operators import push, similarity, slots


def test_slot_merge_and_summary(spark):
    prev = spark.createDataFrame([("u", "015001", 3), ("u", "015002", 2)], "user_id string, slot string, n bigint")
    daily = spark.createDataFrame([("u", "015001", 1)], "user_id string, slot string, n bigint")
    state = slots.merge_slots(prev, daily)
    assert {(r.slot, r.n) for r in state.collect()} == {("015001", 4), ("015002", 2)}
    summ = slots.day_summary(state, daily).first()
    assert summ.summary == "List((015001,4.0))"  # only today's slots, cumulative counts


def test_summary_order_and_pseudo_slot(spark):
    rows = [("u", "d1", "015003", 2), ("u", "d1", "015001", 2), ("u", "d1", "time_tags", 0),
            ("u", "d1", "015002", 5), ("v", "d1", "015001", 1), ("v", "d2", "015004", 1)]
    per_day = spark.createDataFrame(rows, "user_id string, dt string, slot string, n bigint")
    got = {r.user_id: r.summary for r in slots.history_summary(per_day).collect()}
    assert got["u"] == "List((015002,5.0), (015001,2.0), (015003,2.0), (time_tags,0.0))"
    assert got["v"] == "List((015004,1.0))"  # last active day only


def _ui(spark, pairs):
    return spark.createDataFrame(pairs, "user_id string, item string")


def test_similarity_example(spark):
    ui = _ui(spark, [("u1", "a"), ("u1", "b"), ("u2", "a"), ("u2", "b"), ("u3", "a"), ("u3", "c"),
                     ("u3", "c")])  # duplicate input row is ignored
    got = {(r.item, r.neighbour): r.score for r in similarity.similarity(ui).collect()}
    assert math.isclose(got[("a", "b")], 2 / math.sqrt(6)) and math.isclose(got[("a", "c")], 1 / math.sqrt(3))
    assert ("b", "c") not in got and got[("a", "b")] == got[("b", "a")]


def _brute_top(pairs, k):
    users = {}
    for u, i in set(pairs):
        users.setdefault(u, set()).add(i)
    n = {}
    c = {}
    for items in users.values():
        for i in items:
            n[i] = n.get(i, 0) + 1
        for i, j in itertools.permutations(sorted(items), 2):
            c[(i, j)] = c.get((i, j), 0) + 1
    by_item = {}
    for (i, j), cij in c.items():
        by_item.setdefault(i, []).append((-(cij / math.sqrt(n[i] * n[j])), j))
    out = set()
    for i, lst in by_item.items():
        for rank, (s, j) in enumerate(sorted(lst)[:k], 1):
            out.add((i, j, rank))
    return out


def test_top_k_matches_brute_force_with_heavy_users(spark):
    rnd = random.Random(7)
    pairs = [(f"u{rnd.randrange(30)}", f"i{rnd.randrange(40)}") for _ in range(600)]
    pairs += [("heavy", f"i{x}") for x in range(40)]  # one user holding every item
    want = _brute_top(pairs, 6)
    for chunk in (1024, 5, 1):  # one chunk per user, several, one item per chunk
        got = {(r.item, r.neighbour, r.rank) for r in
               similarity.similarity_top_k(_ui(spark, pairs), 6, chunk_items=chunk).collect()}
        assert got == want, chunk


def test_top_k_heavy_user_path_matches_brute_force(spark):
    rnd = random.Random(21)
    pairs = [(f"u{rnd.randrange(40)}", f"i{rnd.randrange(60)}") for _ in range(500)]
    # heavy users with overlapping item sets; ties in frequency are common
    pairs += [("h1", f"i{x}") for x in range(0, 45)]
    pairs += [("h2", f"i{x}") for x in range(20, 60)]
    pairs += [("h3", f"i{x}") for x in range(0, 60, 3)]
    pairs += [("h4", f"i{x}") for x in range(55, 70)]  # items only heavy users hold
    want = _brute_top(pairs, 6)
    for chunk, heavy in ((1024, 8192), (1024, 25), (7, 25), (4, 12), (3, 3)):
        got = {(r.item, r.neighbour, r.rank) for r in
               similarity.similarity_top_k(_ui(spark, pairs), 6, chunk_items=chunk, heavy_items=heavy).collect()}
        assert got == want, (chunk, heavy)


def test_scores_symmetric_and_bounded(spark):
    rnd = random.Random(3)
    pairs = [(f"u{rnd.randrange(20)}", f"i{rnd.randrange(15)}") for _ in range(120)]
    got = {(r.item, r.neighbour): r.score for r in similarity.similarity(_ui(spark, pairs)).collect()}
    for (i, j), s in got.items():
        assert 0 < s <= 1 and got[(j, i)] == s


def _state(spark, rows):
    from decimal import Decimal
    rows = [(u, f, t, Decimal(w)) for u, f, t, w in rows]
    return spark.createDataFrame(rows, "user_id string, family string, tag string, weight decimal(18,2)")


def test_seed_max_and_min(spark):
    st = _state(spark, [("u", "prod_tags", "prod_a", 1), ("u", "prod_tags", "prod_b", 3),
                        ("v", "prod_tags", "prod_b", 2), ("v", "prod_tags", "prod_a", 2),
                        ("u", "be_tags", "t1", 9)])
    mx = {r.user_id: r.item for r in push.seed_item(st, "max").collect()}
    mn = {r.user_id: r.item for r in push.seed_item(st, "min").collect()}
    assert mx == {"u": "b", "v": "a"} and mn == {"u": "a", "v": "a"}  # ties -> smaller id


def test_push_rows_schema_ids_and_exclusion(spark):
    st = _state(spark, [("u1", "prod_tags", "prod_a", 5), ("u1", "prod_tags", "prod_b", 1),
                        ("u2", "prod_tags", "prod_a", 1), ("u2", "prod_tags", "prod_c", 2)])
    rows = push.push_rows(st, "20240102")
    assert [f.name for f in rows.schema.fields] == ["ID", "MEMBER_ID", "PROD_ID", "STATUS"]
    got = sorted((r.MEMBER_ID, r.PROD_ID, r.STATUS, len(r.ID)) for r in rows.collect())
    # u1 seed a -> neighbours b, c ; u2 seed c -> neighbour a
    assert got == [("u1", "b", 1, 32), ("u1", "c", 1, 32), ("u2", "a", 1, 32)]
    again = sorted(r.ID for r in push.push_rows(st, "20240102").collect())
    assert again == sorted(r.ID for r in rows.collect())  # deterministic ids
    excl = sorted((r.MEMBER_ID, r.PROD_ID) for r in push.push_rows(st, "20240102", exclude_seen=True).collect())
    assert excl == [("u1", "c")]


def test_bot_user_holding_every_item(spark):
    """Orders user-items plus one user holding every part: the signature path equals pair enumeration."""
    from conftest import SF_SMOKE
    from pyspark.sql import functions as F

    from tagloom.sources import adapters as A
    from tagloom.sources.tables import table

    bot = table(spark, SF_SMOKE, "part").select(F.lit("bot").alias("user_id"),
                                               F.col("p_partkey").cast("string").alias("item"))
    skewed = A.user_items_large(spark, SF_SMOKE).unionByName(bot)
    via_signature = {tuple(r) for r in similarity.similarity_top_k(skewed, heavy_items=100).collect()}
    via_pairs = {tuple(r) for r in similarity.similarity_top_k(skewed, heavy_items=10 ** 9).collect()}
    assert via_signature == via_pairs and len(via_pairs) > 0


def _mixed_heavy(n_users, n_items, held, seed=5):
    rnd = random.Random(seed)
    pairs = [(f"h{u}", f"i{x}") for u in range(n_users) for x in rnd.sample(range(n_items), held)]
    return pairs + [(f"u{rnd.randrange(50)}", f"i{rnd.randrange(n_items)}") for _ in range(400)]


def test_many_heavy_users_with_mixed_sets(spark):
    """Almost every item has its own set of heavy holders, so nearly all are offered; results stay exact."""
    pairs = _mixed_heavy(20, 60, 30)
    want = _brute_top(pairs, 6)
    got = similarity.similarity_top_k(_ui(spark, pairs), 6, chunk_items=8, heavy_items=20).collect()
    assert {(r.item, r.neighbour, r.rank) for r in got} == want
    users = {}
    for u, i in set(pairs):
        users.setdefault(i, set()).add(u)
    assert all(r.c == len(users[r.item] & users[r.neighbour]) for r in got)


def test_heavy_user_blocks_are_bounded(spark, monkeypatch):
    """Twenty heavy users of 200 of 400 items: no (user, a, b) block holds more than a few chunks of rows."""
    from pyspark.sql import functions as F

    enc, dictionary = similarity._keyed(_ui(spark, _mixed_heavy(20, 400, 200)))
    big = similarity._big_users(enc, 50)
    rows = similarity._with_degrees(enc, big, 100)
    sizes = []
    real = type(rows).join

    def join(self, other, on=None, how=None):
        if on == ["user_id", "a", "b"]:
            for side in (self, other):
                sizes.append(side.groupBy("user_id", "a", "b").count().agg(F.max("count")).first()[0])
        return real(self, other, on, how)

    monkeypatch.setattr(type(rows), "join", join)
    similarity._through_heavy_users(rows, big, dictionary, 6, 25, 100).collect()
    assert len(sizes) == 2 and max(sizes) <= 60  # 25 expected, 200 unsplit


def test_item_hash_collision_takes_another_salt(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = similarity._item_key
    monkeypatch.setattr(similarity, "_item_key", lambda salt: F.lit(1).cast("long") if not salt else real(salt))
    pairs = [("u1", "a"), ("u1", "b"), ("u2", "a"), ("u2", "b"), ("u3", "a"), ("u3", "c")]
    got = {(r.item, r.neighbour, r.rank) for r in similarity.similarity_top_k(_ui(spark, pairs), 6).collect()}
    assert got == _brute_top(pairs, 6)


def test_pair_table_is_not_joined(spark):
    pairs = [(f"u{u}", f"i{x}") for u in range(10) for x in range(u, u + 5)]
    df = similarity.similarity_top_k(_ui(spark, pairs), 6)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = plan[: plan.index("Generate")]  # from the result down to the first pair generator
    assert "collect_set" not in plan and above.count("Window") >= 1
    ranked = above[above.rindex("rank("):]
    assert "Join" not in ranked  # between counting pairs and ranking them


def test_slot_summary_scans_its_input_once(spark):
    from conftest import SF_SMOKE

    from tagloom.sources import adapters as A

    per_day = slots.numbered_days(slots.daily_slots(A.browse(spark, SF_SMOKE), by_day=True))
    for kind in ("today", "all"):
        plan = slots.history_summary(per_day, kind)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan and "SortAggregate" not in plan


def _metric(spark, df, node_name, metric):
    """A metric of the named nodes of a plan that has run."""
    as_java, found = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava, []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == node_name:
            found.append(node.metrics().apply(metric).value())
        for child in as_java(node.children()):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_equal_neighbours_are_cut_before_the_shuffle(spark):
    """100,000 neighbours of one score: every task sends its best by (score, number): k, and one that shows the cut."""
    from pyspark.sql import functions as F

    rows = spark.range(100000, numPartitions=8).select(F.lit(5).alias("item"), ((F.col("id") * 7919) % 100000).alias("neighbour"),
                                                       F.lit(1).alias("c"), F.when(F.col("id") < 3, 0.9).otherwise(0.5).alias("score"))
    best = similarity._best(rows, 6)
    got = sorted((r["rank"], r["neighbour"]) for r in best.collect())
    assert got == [(1, 0), (2, 7919), (3, 15838), (4, 1), (5, 2), (6, 3)]
    moved = _metric(spark, best, "ShuffleExchangeExec", "shuffleRecordsWritten")
    assert moved and max(moved) <= (6 + 1) * 8


def test_item_numbers_rise_with_the_strings(spark):
    items = [f"i{x}" for x in range(300)] + ["", "é", "Z", "~", "i"]
    enc, dictionary = similarity._keyed(_ui(spark, [(f"u{n % 7}", i) for n, i in enumerate(items * 2)]))
    number = {r["item"]: r.iid for r in dictionary.collect()}
    assert [i for i, _ in sorted(number.items(), key=lambda x: x[1])] == sorted(items, key=lambda i: i.encode())
    assert sorted(number.values()) == list(range(len(items)))
    assert {(r.user_id, r["item"]) for r in enc.collect()} == {(f"u{n % 7}", number[i]) for n, i in enumerate(items * 2)}


@pytest.mark.parametrize("hub", [1 << 14, 4])
def test_top_k_by_item_equals_brute_force(spark, monkeypatch, hub):
    """Many items: pairs are counted at their item, hubs in slices; every bound gives the same rows and counts."""
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    monkeypatch.setattr(similarity, "HUB_USERS", hub)
    rnd = random.Random(11)
    pairs = [(f"u{rnd.randrange(40)}", f"i{rnd.randrange(60)}") for _ in range(500)]
    pairs += [("h1", f"i{x}") for x in range(0, 45)] + [("h2", f"i{x}") for x in range(20, 60)]
    pairs += [("h3", f"i{x}") for x in range(0, 60, 3)] + [("h4", f"i{x}") for x in range(55, 90)]  # many items of h4 alone: not all offered
    pairs += [(f"p{x}", f"q{x % 2}") for x in range(8)] + [("p1", "i3"), ("z", "alone")]
    want, users = _brute_top(pairs, 6), {}
    for u, i in set(pairs):
        users.setdefault(i, set()).add(u)
    for chunk, heavy in ((1024, 8192), (5, 8192), (1024, 25), (7, 25), (3, 3)):
        got = similarity.similarity_top_k(_ui(spark, pairs), 6, chunk_items=chunk, heavy_items=heavy).collect()
        assert {(r.item, r.neighbour, r.rank) for r in got} == want, (chunk, heavy)
        assert all(r.c == len(users[r.item] & users[r.neighbour]) for r in got)


@pytest.mark.parametrize("hub", [1 << 14, 4])
def test_pairs_of_many_items_move_as_arrays(spark, monkeypatch, hub):
    """Pairs are made, counted and placed after one shuffle of arrays, and few of them are kept."""
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    monkeypatch.setattr(similarity, "HUB_USERS", hub)
    seen, real = {}, similarity.cut_lineage

    def cut(df, name, *args, **kw):
        out = real(df, name, *args, **kw)
        if name == "similarity-kept-pairs":
            seen["plan"], seen["kept"] = df._jdf.queryExecution().executedPlan().toString(), out.count()
        return out

    monkeypatch.setattr(similarity, "cut_lineage", cut)
    pairs = [(f"u{u}", f"i{(u * 37 + x * x) % 2000}") for u in range(200) for x in range(40)]
    similarity.similarity_top_k(_ui(spark, pairs), 6).collect()
    held = {}
    for u, i in set(pairs):
        held.setdefault(u, set()).add(i)
    assert 0 < seen["kept"] < sum(len(h) * (len(h) - 1) // 2 for h in held.values()) / 3
    assert seen["plan"].split("== Initial Plan ==")[0].count("Exchange") == 1
