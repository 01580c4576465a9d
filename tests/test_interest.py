"""Interest merge: the truth table of FIXTURES section 3 and the survey's properties."""

from decimal import Decimal as D

from conftest import SF_SMOKE
from pyspark.sql import functions as F

from tagloom.operators import interest as I
from tagloom.sources import adapters as A

STATE = "user_id string, family string, tag string, weight decimal(18,2)"
DAILY = "user_id string, family string, tag string, new_w decimal(18,2)"


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE)


def _daily(spark, rows):
    return spark.createDataFrame(rows, DAILY)


def _as_dict(df):
    return {(r.user_id, r.family, r.tag): r.weight for r in df.collect()}


def test_known_user_truth_table(spark):
    prev = _state(spark, [
        ("k", "be_tags", "a", D("1.00")),     # old + new
        ("k", "be_tags", "b", D("1.34")),     # old only -> raw 1.005 -> 1.01 (half up)
        ("k", "be_tags", "c", D("0.56")),     # old only -> raw 0.42 -> dropped
        ("k", "prod_tags", "prod_1", D("2.00")),
    ])
    daily = _daily(spark, [("k", "be_tags", "a", D(3)), ("k", "be_tags", "z", D(0))])  # z: new 0 -> dropped
    got = _as_dict(I.merge_interest(prev, daily))
    assert got == {("k", "be_tags", "a"): D("3.00"), ("k", "be_tags", "b"): D("1.01"),
                   ("k", "prod_tags", "prod_1"): D("1.50")}
    stale = _as_dict(I.merge_interest(prev, daily, expire="keep_stale"))
    assert stale[("k", "be_tags", "c")] == D("0.56")
    assert ("k", "be_tags", "z") not in stale


def test_threshold_uses_unrounded_value(spark):
    # 0.67 * 0.75 = 0.5025 > 0.5 -> kept and stored as 0.50
    prev = _state(spark, [("k", "be_tags", "a", D("0.67")), ("k", "prod_tags", "prod_1", D("9.00"))])
    daily = _daily(spark, [("k", "prod_tags", "prod_1", D(1))])
    assert _as_dict(I.merge_interest(prev, daily))[("k", "be_tags", "a")] == D("0.50")


def test_new_user_no_threshold(spark):
    prev = _state(spark, [])
    daily = _daily(spark, [("n", "be_tags", "a", D(0)), ("n", "prod_tags", "prod_2", D(3))])
    assert _as_dict(I.merge_interest(prev, daily)) == {("n", "be_tags", "a"): D("0.00"),
                                                       ("n", "prod_tags", "prod_2"): D("2.25")}


def test_history_in_one_family_only_is_new(spark):
    prev = _state(spark, [("h", "be_tags", "a", D("4.00")), ("h", "be_tags", "b", D("0.10"))])
    daily = _daily(spark, [("h", "be_tags", "a", D(2))])
    # present key overwritten by new * 0.75 (history not added), other old keys untouched
    assert _as_dict(I.merge_interest(prev, daily)) == {("h", "be_tags", "a"): D("1.50"),
                                                       ("h", "be_tags", "b"): D("0.10")}


def test_absent_user_unchanged_and_empty_day_carries_over(spark):
    prev = _state(spark, [("x", "be_tags", "a", D("0.60")), ("x", "prod_tags", "prod_1", D("0.52"))])
    daily = _daily(spark, [("y", "be_tags", "a", D(1))])
    got = _as_dict(I.merge_interest(prev, daily))
    assert got[("x", "be_tags", "a")] == D("0.60") and got[("x", "prod_tags", "prod_1")] == D("0.52")
    assert _as_dict(I.merge_interest(prev, _daily(spark, []))) == _as_dict(prev)


def test_tag_rows_rules(spark):
    b = spark.createDataFrame([
        ("u", "", "5", "0", "d"),      # blank type -> pseudo tag 0; product weight 8
        ("u", None, None, "7", "d"),   # NULL type -> pseudo tag; NULL product -> no row
        ("u", "t1", "6", None, "d"),   # NULL behaviour -> weight 0, tags still made
    ], "id string, type_id string, prod_id string, behavior_id string, dt string")
    rows = sorted((r.family, r.tag, r.w) for r in I.tag_rows(b).collect())
    assert rows == [("be_tags", "t1", 0), ("be_tags", "type_id", 0), ("be_tags", "type_id", 0),
                    ("prod_tags", "prod_5", 8), ("prod_tags", "prod_6", 0)]
    with_null = sorted(r.tag for r in I.tag_rows(b, keep_null_product=True).collect() if r.family == "prod_tags")
    assert with_null == ["prod_5", "prod_6", "prod_null"]


def test_fold_equals_two_steps_and_rerun_is_identical(spark):
    from conftest import SF_SMOKE
    from tagloom.sources import adapters as A

    beh = A.behavior(spark, SF_SMOKE)
    days = ["20240101", "20240102", "20240103"]
    folded = _as_dict(I.replay_interest(beh, days))
    s1 = I.replay_interest(beh, days[:1])
    s2 = I.merge_interest(s1, I.daily_interest(A.behavior(spark, SF_SMOKE, days[1])))
    s3 = I.merge_interest(s2, I.daily_interest(A.behavior(spark, SF_SMOKE, days[2])))
    assert folded == _as_dict(s3)
    cut = _as_dict(I.replay_interest(beh, days, checkpoint_every=1))
    assert cut == folded
    assert len(folded) == 159  # FIXTURES section 4


def test_keep_stale_is_superset(spark):
    from conftest import SF_SMOKE
    from tagloom.sources import adapters as A

    beh = A.behavior(spark, SF_SMOKE)
    drop = _as_dict(I.replay_interest(beh, ["20240101", "20240102"]))
    stale = _as_dict(I.replay_interest(beh, ["20240101", "20240102"], expire="keep_stale"))
    assert set(drop) <= set(stale) and (len(drop), len(stale)) == (113, 117)


def test_decay_inactive_option(spark):
    prev = _state(spark, [("x", "be_tags", "a", D("2.00")), ("x", "prod_tags", "prod_1", D("0.60")),
                          ("h", "be_tags", "a", D("4.00"))])
    daily = _daily(spark, [("y", "be_tags", "a", D(1))])
    got = _as_dict(I.merge_interest(prev, daily, decay_inactive=True))
    # known inactive user decays and expires; a user with one family only is left as is
    assert got[("x", "be_tags", "a")] == D("1.50") and ("x", "prod_tags", "prod_1") not in got
    assert got[("h", "be_tags", "a")] == D("4.00")


def test_decay_and_threshold_keep_their_digits(spark):
    from decimal import Decimal

    import pytest

    state = spark.createDataFrame([("u", "be_tags", "t", Decimal(100)), ("u", "prod_tags", "prod_p", Decimal("0.51"))], I.STATE_SCHEMA)
    today = spark.createDataFrame([("u", "be_tags", "x", Decimal(1))], "user_id string, family string, tag string, new_w decimal(18,2)")
    for decay, want in ((0.995, "99.50"), (0.985, "98.50"), (0.75, "75.00"), (1.0, "100.00"), (0.333333, "33.33")):
        got = {r.tag: str(r.weight) for r in I.merge_interest(state, today, decay=decay, threshold=0.0).collect()}
        assert got["t"] == want, decay
    kept = {r.tag for r in I.merge_interest(state, today, decay=1.0, threshold=0.509).collect()}
    assert "prod_p" in kept
    assert "prod_p" not in {r.tag for r in I.merge_interest(state, today, decay=1.0, threshold=0.5101).collect()}
    with pytest.raises(ValueError):
        I.merge_interest(state, today, decay=1 / 3)


def _jobs(spark, run):
    """Spark jobs that ``run`` starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_all_days_at_once_equal_day_by_day(spark, monkeypatch):
    """The same state with null users, decay of inactive users, a state before, and flags in several words; jobs don't grow with days."""
    beh = A.behavior(spark, SF_SMOKE)
    days = [f"202401{d:02d}" for d in range(1, 31)]
    beh = beh.unionByName(beh.where("id = '3'").withColumn("id", F.lit(None).cast("string")))
    for options in ({}, {"expire": "keep_stale"}, {"decay_inactive": True}, {"decay": 0.5, "threshold": 1.5}):
        want = _as_dict(I.replay_interest(beh, days[:9], checkpoint_every=3, **options))
        assert _as_dict(I.replay_interest(beh, days[:9], **options)) == want, options
        with monkeypatch.context() as m:
            m.setattr(I, "WORD", 2)
            assert _as_dict(I.replay_interest(beh, days[:9], **options)) == want, options
    prev = I.replay_interest(beh, days[:10])
    assert _as_dict(I.replay_interest(beh, days[10:], prev=prev)) == _as_dict(I.replay_interest(beh, days))
    few, many = (_jobs(spark, lambda n=n: I.replay_interest(beh, days[:n]).collect()) for n in (10, 30))
    assert many <= few + 8  # a further round at most


def test_days_are_folded_in_batches_of_exact_integers(spark, monkeypatch):
    """Cells are folded by batches and not by an interpreted expression a day; weights beyond 64 bits once multiplied, and more days than a word, stay exact."""
    plans, real = [], I.cut_lineage

    def cut(df, name, *args, **kw):
        if name == "interest-folded":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, *args, **kw)

    monkeypatch.setattr(I, "cut_lineage", cut)
    days = [f"d{i:03d}" for i in range(70)]
    big, decay = D("9999999999999999.99"), 0.123456789
    rows = [("u", days[0], "be_tags", "t", big), ("u", days[0], "prod_tags", "p", D("1.00")), ("u", days[64], "be_tags", "t", -big),
            ("u", days[69], "prod_tags", "p", D("7.77")), (None, days[3], "be_tags", "t", D("-0.50")), ("v", days[69], "prod_tags", "p", None)]
    per_day = spark.createDataFrame(rows, "user_id string, dt string, family string, tag string, new_w decimal(18,2)")
    got = {(r.user_id, r.tag): r.weight for r in I._folded(per_day, days, None, "drop", False, decay, 0.0).collect()}
    q = lambda x: x.quantize(D("0.01"), "ROUND_HALF_UP")
    first = q(big * D(repr(decay)))
    assert (first - big) * D(repr(decay)) < 0  # so the type cell expires on day 64, and the user is new again on day 69
    assert got == {("u", "p"): q(D("7.77") * D(repr(decay))), (None, "t"): q(D("-0.50") * D(repr(decay)))}
    assert plans and all("MapInArrow" in plan and "lambda" not in plan.split("MapInArrow")[0] for plan in plans)
