"""Figures from FIXTURES section 4 (scratch runs of both engines) reproduced by the registered queries."""

from collections import Counter

import pytest
from conftest import SF_CHECK, SF_SMOKE

import __spark_entry__ as E
from tagloom.operators import interest, push
from tagloom.sources import adapters as A


def _count(spark, name, sf):
    return E.queries()[name](spark, sf).count()


@pytest.mark.parametrize("name,sf,rows", [
    ("merge_interest_day", SF_SMOKE, 113),
    ("merge_interest_3days", SF_SMOKE, 159),
    ("push_rows_two_days", SF_SMOKE, 62),
    ("slot_counts", SF_SMOKE, 86),
    ("slot_summary", SF_SMOKE, 15),
    ("slot_counts", SF_CHECK, 854),
    ("item_similarity_top6", SF_CHECK, 600),
])
def test_row_counts(spark, name, sf, rows):
    assert _count(spark, name, sf) == rows


def test_two_day_state_options(spark):
    beh, days = A.behavior(spark, SF_SMOKE), ["20240101", "20240102"]
    assert interest.replay_interest(beh, days, expire="keep_stale").count() == 117
    assert push.push_rows(interest.replay_interest(beh, days), "20240102", seed="min").count() == 55


@pytest.mark.parametrize("name,expected", [
    ("tag_age_band", [328, 232, 133, 177, 291, 323, 16]),
    ("tag_age_band_reference", [328, 235, 130, 177, 291, 323, 16]),
])
def test_age_band_counts(spark, name, expected):
    c = Counter(r.value for r in E.queries()[name](spark, SF_CHECK).collect())
    codes = ["002001", "002002", "002003", "002004", "002005", "002006", "unknown"]
    assert [c[k] for k in codes] == expected
