"""Driver contract: entry(), registry consistency, and the DuckDB oracle on the smoke scale."""

import re

import pytest
from conftest import SF_SMOKE
from oracle_harness import compare, duck

import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["ID", "MEMBER_ID", "PROD_ID", "STATUS"]
    assert df.count() == 62  # FIXTURES section 4, sf0.001, seed max


def test_registry_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 55


#: Every registered query with SQL, but for the optional part's, which its own tests compare.
COMPARED = sorted(n for n in E.oracle_sql() if not re.match(r"op\d+_", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", COMPARED)
def test_oracle_smoke(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMOKE)
    assert r["cols_match"] and r["values_match"], r


def test_every_query_is_documented():
    import os
    readme = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")).read()
    assert [n for n in E.queries() if f"`{n}`" not in readme] == []
