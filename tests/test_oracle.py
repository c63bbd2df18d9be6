"""Every query with a SQL twin gives its rows; every query without one runs."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from oracle import connect, difference

WITH_SQL = sorted(entry.oracle_sql())
WITHOUT_SQL = sorted(set(entry.queries()) - set(WITH_SQL))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", WITH_SQL)
def test_equal_to_sql(spark, con, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country_code", "sales", "prop_in_group", "prop_overall", "prop_cumsum"]
    assert df.count() >= 0
