"""Kept pair counts: after every day equal to a full count, and made from changed users only."""

import itertools
import random
from collections import Counter

import pytest

from tagloom.operators import pair_state as P
from tagloom.operators import similarity


def items(spark, held):
    return spark.createDataFrame([(u, i) for u, own in held.items() for i in sorted(own)], "user_id string, item string")


def counts(held):
    pairs, degrees = Counter(), Counter()
    for own in held.values():
        degrees.update(own)
        pairs.update(itertools.combinations(sorted(own), 2))
    return dict(pairs), dict(degrees)


@pytest.mark.parametrize("block", [P.BLOCK, 2])
def test_counts_after_each_day_equal_a_full_count(spark, tmp_dir, block):
    rng = random.Random(block)
    layout = {"buckets": 2, "compact_share": 100.0}
    held = {}
    for n in range(4):
        old = {u: set(own) for u, own in held.items()}
        for u in [None, "", *(f"u{rng.randrange(12)}" for _ in range(5 if n else 30))]:
            own = held.setdefault(u, set())
            own.update(f"i{rng.randrange(9)}" for _ in range(4))
            own -= {f"i{rng.randrange(9)}" for _ in range(3)}
        touched = {u for u in held if held[u] != old.get(u, set())}
        dt = f"2024010{n + 1}"
        made = P.pair_job(spark, tmp_dir, dt, f"2024010{n}" if n else None, items(spark, old), items(spark, held), block, **layout)
        pairs, degrees = counts(held)
        assert {(r.user_id, r.tag): r.n for r in P.pair_store(spark, tmp_dir).read(dt).collect()} == pairs
        assert {r.user_id: r.n for r in P.degree_store(spark, tmp_dir).read(dt).collect()} == degrees
        before = counts(old)[0]
        differ = {p for p in pairs.keys() | before.keys() if pairs.get(p) != before.get(p)}
        assert made == len(differ) == P.pair_store(spark, tmp_dir).version(dt).rows or n == 0 and made == len(pairs)
        changed = {r.user_id for r in P.changed_items(items(spark, old), items(spark, held)).select("user_id").distinct().collect()}
        assert changed == touched  # no other user's pairs are made
        want = {tuple(r) for r in similarity.similarity_top_k(items(spark, held)).collect()}
        assert {tuple(r) for r in P.kept_top_k(spark, tmp_dir, dt).collect()} == want
    # a day without changes writes none; running it again gives the same
    for _ in range(2):
        assert P.pair_job(spark, tmp_dir, "20240105", "20240104", items(spark, held), items(spark, held), block, **layout) == 0
    assert {(r.user_id, r.tag): r.n for r in P.pair_store(spark, tmp_dir).read("20240105").collect()} == counts(held)[0]


def test_a_missing_day_before_is_an_error(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="20240101"):
        P.pair_job(spark, tmp_dir, "20240102", "20240101", items(spark, {"u": {"a"}}), items(spark, {"u": {"a", "b"}}))
