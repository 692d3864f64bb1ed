"""Every registered query equals its DuckDB oracle on the test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from ordermill.plans import catalog

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_oracle_sql():
    assert set(catalog.QUERIES) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(entry.queries()[name](spark, sf_dir), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_order_value" in df.columns
