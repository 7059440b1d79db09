"""Spark and SQL answer alike on rows that the given tables lack: nulls, ties, odd JSON,
missing months, other statuses."""

from __future__ import annotations

from datetime import datetime

import pytest

from compare import assert_same, duckdb_over
from conftest import at
from millrace.plans.oracle import ORACLE_SQL
from millrace.plans.registry import QUERIES
from millrace.sources.tables import SCHEMAS

EVENTS = [
    (1, at(0), 1, "view", 1.0, '{"k": 3}'),
    (2, at(0), 1, "purchase", 1.0, '{"k": "12"}'),
    (3, at(0), 1, "view", 1.0, '{"k": 12.5}'),
    (4, at(0), 1, "purchase", 1.0, '{"k": "1e3"}'),
    (6, at(10), 1, "purchase", 1.0, '{"k": "+7"}'),
    (5, at(10), 1, "view", 1.0, '{"k": -4}'),
    (7, at(41), 1, "click", 1.0, '{"k": null}'),
    (8, None, 1, "view", 1.0, "{}"),
    (9, None, 1, "purchase", 1.0, "no json"),
    (10, at(5), None, "view", 1.0, None),
    (11, at(6), None, "purchase", 1.0, '{"k": " 5"}'),
    (12, at(7), 2, "purchase", 1.0, '{"k": "99999999999999999999"}'),
    (13, at(900), 2, None, None, '{"k": 1}'),
]
BATCH = [
    "events_hourly",
    "events_sliding",
    "last_view_before_purchase",
    "json_prop_totals",
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = spark.createDataFrame(EVENTS, SCHEMAS["events"]).coalesce(1)
    rows.write.parquet(f"{folder}/events.parquet")
    day = lambda y, m, d: datetime(y, m, d)
    orders = [
        (1, 1, "F", 10.25, day(2024, 1, 3), "a"),
        (2, 1, "X", 20.5, day(2024, 2, 3), "a"),
        (3, 1, None, 30.0, day(2024, 6, 3), "a"),
        (4, 1, "O", 40.0, day(2024, 7, 1), None),
        (5, 1, "P", 50.0, day(2024, 8, 31), "b"),
        (6, 1, "P", 93.0, None, "b"),
        (7, 1, "F", 1.0, day(2025, 1, 1), "b"),
        (8, 1, "F", 2.0, day(2025, 2, 1), "b"),
    ]
    rows = spark.createDataFrame(orders, SCHEMAS["orders"])
    rows.write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize(
    "name", [*BATCH, "monthly_revenue_trend", "orders_priority_by_status"]
)
def test_odd_rows(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), ORACLE_SQL[name]) > 0


def test_months_without_orders_are_no_neighbours(spark, sf_dir):
    rows = {
        row.order_month and row.order_month.strftime("%Y-%m"): (
            row.change and float(row.change),
            row.three_months and float(row.three_months),
        )
        for row in QUERIES["monthly_revenue_trend"](spark, sf_dir).collect()
    }
    assert rows == {
        "2024-01": (None, 10.25),
        "2024-02": (10.25, 30.75),
        "2024-06": (None, 30.0),
        "2024-07": (10.0, 70.0),
        "2024-08": (10.0, 120.0),
        "2025-01": (None, 1.0),
        "2025-02": (1.0, 3.0),
        None: (None, None),
    }


def test_columns_add_up_to_all_orders(spark, sf_dir):
    rows = QUERIES["orders_priority_by_status"](spark, sf_dir).collect()
    assert sum(sum(tuple(row)[1:]) for row in rows) == 8
