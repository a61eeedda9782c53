"""Every registered job against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
import oracle_check as oc

NAMES = sorted(E.ORACLE_SQL)


@pytest.fixture(scope="module")
def duck(small_dir):
    return oc.duck(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, small_dir, duck, name):
    r = oc.check(spark, name, E.queries()[name], E.oracle_sql()[name], small_dir, duck)
    assert r["ok"], r


def test_every_query_has_oracle_or_is_documented():
    no_sql = set(E.QUERIES) - set(E.ORACLE_SQL)
    assert no_sql == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["id", "o_orderstatus", "o_orderpriority", "o_orderdate"]


def test_registry_contract():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert all(name.startswith("j") and name[1:3].isdigit() for name in E.QUERIES)
