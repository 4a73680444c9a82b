"""Every registered query against its independent DuckDB SQL (same check as the driver's)."""

import pytest

import __spark_entry__ as entry
from gridmart.plans.queries import QUERIES
from gridmart.plans.verify import compare_one, duckdb_connection

from data_paths import SF001, SF01

SQL = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def con001():
    return duckdb_connection(SF001)


@pytest.fixture(scope="module")
def con01():
    return duckdb_connection(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle_sf0001(spark, con001, name):
    r = compare_one(spark, SF001, name, QUERIES[name], SQL[name], con001)
    assert r["match"], r


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle_sf001(spark, con01, name):
    r = compare_one(spark, SF01, name, QUERIES[name], SQL[name], con01)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 42  # daily rows at sf0.001
    assert "avg_price_eur_mwh" in df.columns
