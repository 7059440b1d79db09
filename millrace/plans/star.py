"""Queries over orders, lines, customers and suppliers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.values import (
    hundredths,
    split_sum,
    split_sum_again,
    split_total,
    whole,
)
from millrace.operators.aggregates import count_cube, count_matrix, duplicate_keys
from millrace.operators.joins import keys_in_first_only, rows_without_match
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.ranking import top_per_group
from millrace.operators.running import percentiles
from millrace.sources.partitioned import write_partitioned
from millrace.sources.shared import new_run_dir
from millrace.sources.tables import table


def revenue_by_region_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and net revenue shipped since 1997, per region and order year.

    Lines are summed per order before the join: the join needs them partitioned by
    order anyway, and then sorts one row per order. Sums per nation and year are
    taken before nations and regions come in, so those joins see a few rows. No size
    is assumed for orders or customers; Spark broadcasts a side only when its files
    are small, and adaptive execution splits a customer with very many orders.
    """
    revenue = hundredths("l_extendedprice") * (100 - hundredths("l_discount"))
    per_order = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") >= F.expr("timestamp_ntz'1997-01-01 00:00:00'"))
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"), *split_sum(revenue, "revenue"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", whole(F.year("o_orderdate")).alias("order_year")
    )
    per_nation = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "order_year")
        .agg(F.sum("n_lines").alias("n_lines"), *split_sum_again("revenue"))
    )
    return (
        per_nation.join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"), "order_year")
        .agg(F.sum("n_lines").alias("n_lines"), *split_sum_again("revenue"))
        .select("region", "order_year", "n_lines", split_total("revenue", 4).alias("revenue"))
    )


def line_counts_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts by return flag and line status with all subtotals."""
    lines = table(spark, sf_dir, "lineitem")
    return count_cube(lines, ["l_returnflag", "l_linestatus"], "n_lines")


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have no line."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return rows_without_match(orders, "o_orderkey", lines, "l_orderkey")


def duplicate_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality check: line numbers used more than once in an order."""
    lines = table(spark, sf_dir, "lineitem")
    return duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "n_lines")


def top_customers_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 customers of each nation with the highest order value."""
    spent = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(*split_sum(hundredths("o_totalprice"), "value"))
        .select("c_custkey", split_total("value", 2).alias("order_value"))
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey"
    )
    top = top_per_group(
        spent.join(customers, "c_custkey"),
        "c_nationkey",
        [F.desc("order_value"), F.asc("c_custkey")],
        3,
    )
    nations = table(spark, sf_dir, "nation")
    return top.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("nation"), "rank", "c_custkey", "c_name", "order_value"
    )


def monthly_revenue_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per month, the change from the month before and the sum over
    three months.

    Months are calendar months: one without orders counts as nothing in the sum, and
    the month after it has no change. Orders without a date are a month of their own
    that has neither. The windows run over one row per calendar month.
    """
    month = F.trunc("o_orderdate", "month").cast("timestamp_ntz")
    months = (
        table(spark, sf_dir, "orders")
        .groupBy(month.alias("order_month"))
        .agg(*split_sum(hundredths("o_totalprice"), "value"))
        .select("order_month", split_total("value", 2).alias("order_value"))
    )
    number = F.year("order_month") * 12 + F.month("order_month")
    months = months.withColumn("number", number)
    known = F.col("number").isNotNull()
    in_order = Window.partitionBy(known).orderBy("number")
    follows = F.lag("number").over(in_order) == F.col("number") - 1
    before = F.when(follows, F.lag("order_value").over(in_order))
    change = F.col("order_value") - before
    moving = F.when(known, F.sum("order_value").over(in_order.rangeBetween(-2, 0)))
    return months.select(
        "order_month",
        "order_value",
        change.cast("decimal(38,2)").alias("change"),
        moving.cast("decimal(38,2)").alias("three_months"),
    )


def orders_priority_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per priority, one column per status and one for any other or none."""
    return count_matrix(
        table(spark, sf_dir, "orders"),
        "o_orderpriority",
        "o_orderstatus",
        {"F": "n_f", "O": "n_o", "P": "n_p"},
        "n_other",
    )


def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median and 95th percentile of the line price per return flag."""
    return exact_quantiles(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        "l_extendedprice",
        {"median_price": Decimal("0.5"), "p95_price": Decimal("0.95")},
    )


def nations_without_poor_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that have customers and no supplier with a balance under 5000."""
    poor = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") < 5000)
    keys = keys_in_first_only(
        table(spark, sf_dir, "customer"), "c_nationkey", poor, "s_nationkey", "n_nationkey"
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nations.join(keys, "n_nationkey", "left_semi")


def write_orders_by_year(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """All orders at ``path``, one folder per order year; the table written."""
    orders = table(spark, sf_dir, "orders")
    by_year = orders.withColumn("order_year", F.year("o_orderdate"))
    return write_partitioned(by_year, path, "order_year")


def orders_by_year_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all orders by year, read the table back and sum it up per year."""
    path = f"{new_run_dir(spark, 'orders_by_year')}/table"
    return (
        write_orders_by_year(spark, sf_dir, path)
        .groupBy(whole("order_year").alias("order_year"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            *split_sum(hundredths("o_totalprice"), "value"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
        .select(
            "order_year",
            "n_orders",
            split_total("value", 2).alias("order_value"),
            "first_order",
            "last_order",
        )
    )


def order_value_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's rank, percentage and hundredth by value, over all orders."""
    orders = table(spark, sf_dir, "orders")
    return percentiles(orders, "o_totalprice", "o_orderkey", 100)
