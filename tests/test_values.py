"""Exact money arithmetic on integers."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import TESTDATA
from millrace.functions.values import (
    hundredths,
    split_sum,
    split_sum_again,
    split_total,
)
from millrace.sources.tables import table

CENTS = st.integers(-(10**12), 10**12)


@settings(max_examples=15, deadline=None)
@given(st.lists(CENTS, min_size=1, max_size=300))
def test_hundredths_of_stored_amounts(spark, cents):
    """What an amount with two decimals becomes as a double and back."""
    df = spark.createDataFrame([(float(Decimal(c) / 100), c) for c in cents], "x double, c bigint")
    assert df.filter(hundredths("x") != F.col("c")).count() == 0


def test_hundredths_agree_with_decimals_in_the_tables(spark):
    lines = table(spark, f"{TESTDATA}/sf0.1", "lineitem")
    for column in ("l_extendedprice", "l_discount"):
        as_decimal = (F.col(column).cast("decimal(12,2)") * 100).cast("bigint")
        assert lines.filter(hundredths(column) != as_decimal).count() == 0


def test_hundredths_keep_nulls_and_signs(spark):
    df = spark.createDataFrame([(0.12,), (-0.12,), (0.0,), (None,)], "x double")
    assert [row[0] for row in df.select(hundredths("x")).collect()] == [12, -12, 0, None]


@pytest.mark.parametrize(
    "value", [float("nan"), float("inf"), float("-inf"), 1e18, 12.3456, 0.005, -0.125]
)
def test_hundredths_refuse_what_is_no_amount(spark, value):
    df = spark.createDataFrame([(1.25,), (value,)], "x double")
    with pytest.raises(Exception, match="not an amount with two decimals"):
        df.select(hundredths("x")).collect()


def test_totals_beyond_bigint_are_exact(spark):
    rng = random.Random(4)
    units = [rng.randrange(-(10**14), 9 * 10**18) for _ in range(500)]
    df = spark.createDataFrame([(i % 7, u) for i, u in enumerate(units)], "g int, u bigint")
    per_group = df.groupBy("g").agg(*split_sum(F.col("u"), "t"))
    total = per_group.agg(*split_sum_again("t")).select(split_total("t", 4).alias("t"))
    assert sum(units) > 2**63
    assert total.first().t == Decimal(sum(units)) / 10_000
    assert total.schema["t"].dataType.simpleString() == "decimal(38,4)"


def test_total_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, None)], "g int, u bigint")
    total = df.groupBy("g").agg(*split_sum(F.col("u"), "t")).select(split_total("t", 2))
    assert total.first()[0] is None
