"""Every registered query against its SQL in DuckDB: types, rows and values."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import assert_same, duckdb_over, rows_of
from conftest import TESTDATA
from millrace.plans.oracle import ORACLE_SQL
from millrace.plans.registry import QUERIES

NAMES = list(QUERIES)
JOINS = [
    "revenue_by_region_year",
    "orders_without_lines",
    "top_customers_per_nation",
    "price_quantiles",
    "nations_without_poor_suppliers",
    "overlapping_sessions",
    "order_value_percentiles",
    "last_view_before_purchase",
]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"{TESTDATA}/{scale}"
    df = QUERIES[name](spark, sf_dir)
    rows = assert_same(df, duckdb_over(sf_dir), ORACLE_SQL[name])
    # At the smallest scale each nation may well have a poor supplier.
    assert rows > 0 or (name, scale) == ("nations_without_poor_suppliers", "sf0.001")


@pytest.mark.parametrize("name", JOINS)
def test_query_without_broadcast(spark, conf, name):
    """The plans used when no side is small give the same rows."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    sf_dir = f"{TESTDATA}/sf0.01"
    df = QUERIES[name](spark, sf_dir)
    assert_same(df, duckdb_over(sf_dir), ORACLE_SQL[name])


@pytest.mark.parametrize("name", NAMES)
def test_query_in_another_time_zone(spark, conf, name):
    """The tables hold times without zone, so the session's zone must not matter."""
    conf("spark.sql.session.timeZone", "America/Sao_Paulo")
    sf_dir = f"{TESTDATA}/sf0.001"
    df = QUERIES[name](spark, sf_dir)
    assert_same(df, duckdb_over(sf_dir), ORACLE_SQL[name])


def test_sql_is_given_for_every_query():
    assert set(ORACLE_SQL) == set(NAMES)


def test_the_contract_names_every_query():
    assert set(NAMES) <= set(contract.queries())
    assert set(NAMES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "order_year", "n_lines", "revenue"]
    assert sum(rows_of(df).values()) > 0
