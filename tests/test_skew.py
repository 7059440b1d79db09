"""A third of the rows on one order, one customer and one user: right results, and no
task that reads them all."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from compare import assert_same, duckdb_over
from conftest import TESTDATA
from millrace.plans import star
from millrace.plans.oracle import ORACLE_SQL
from millrace.plans.registry import QUERIES
from millrace.sources.tables import table

HOT = 7
ROWS = {"lineitem": 600_000, "orders": 150_000, "events": 100_000}
# Query and the largest table it reads.
READS = {
    "revenue_by_region_year": "lineitem",
    "line_counts_cube": "lineitem",
    "orders_without_lines": "lineitem",
    "duplicate_line_keys": "lineitem",
    "top_customers_per_nation": "orders",
    "monthly_revenue_trend": "orders",
    "orders_priority_by_status": "orders",
    "price_quantiles": "lineitem",
    "orders_by_year_sink": "orders",
    "events_hourly": "events",
    "events_sliding": "events",
    "user_sessions": "events",
    "weekly_active_users": "events",
    "funnel_view_signup_purchase": "events",
    "last_view_before_purchase": "events",
    "json_prop_totals": "events",
    "latest_event_per_user": "events",
    "stream_events_hourly": "events",
    "stream_user_sessions": "events",
    "stream_dedup": "events",
    "stream_inactive_users": "events",
    "stream_revenue_upserts": "lineitem",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The sf0.1 tables with every third row's key replaced, in 16 files each."""
    sf_dir = str(tmp_path_factory.mktemp("skewed"))
    source = f"{TESTDATA}/sf0.1"
    for name in ("region", "nation", "customer", "supplier"):
        table(spark, source, name).write.parquet(f"{sf_dir}/{name}.parquet")
    for name, keys, spread in (
        ("orders", ["o_custkey"], "o_orderkey"),
        ("lineitem", ["l_orderkey"], "l_extendedprice"),
        ("events", ["user_id"], "event_id"),
    ):
        third = F.pmod(F.xxhash64(spread), F.lit(3)) == 0
        df = table(spark, source, name)
        for key in keys:
            moved = F.when(third, F.lit(HOT).cast("bigint")).otherwise(F.col(key))
            df = df.withColumn(key, moved)
        # Files by time keep the events' order.
        in_order = df.repartitionByRange(16, df.columns[0])
        in_order.write.parquet(f"{sf_dir}/{name}.parquet")
    return sf_dir


@pytest.fixture
def small_tasks(conf):
    """Settings that treat these small tables as a cluster treats large ones."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")


def most_read_by_a_task(spark, event_log, started_after: int) -> int:
    """The most shuffled records that one task of the later stages read."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for path in event_log.rglob("events_*"):
        for line in path.read_text().splitlines():
            if '"Event":"SparkListenerTaskEnd"' not in line:
                continue
            task = json.loads(line)
            if task["Task Info"]["Launch Time"] >= started_after:
                metrics = task.get("Task Metrics") or {}
                read = metrics.get("Shuffle Read Metrics", {})
                most = max(most, read.get("Total Records Read", 0))
    return most


@pytest.mark.parametrize("name", READS)
def test_hot_key_is_spread(spark, skewed, small_tasks, event_log, name):
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    df = QUERIES[name](spark, skewed)
    df.write.format("noop").mode("overwrite").save()
    # The hot key alone has a third of the rows, an even share is a sixteenth.
    assert 0 < most_read_by_a_task(spark, event_log, now) < ROWS[READS[name]] / 6


@pytest.mark.parametrize("name", READS)
def test_skewed_results_equal_sql(spark, skewed, small_tasks, name):
    df = QUERIES[name](spark, skewed)
    assert assert_same(df, duckdb_over(skewed), ORACLE_SQL[name]) > 0


def test_the_check_sees_a_hot_key(spark, skewed, small_tasks, event_log):
    """A plain window over a user does read a third of the rows in one task."""
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    naive = table(spark, skewed, "events").selectExpr(
        "lag(ts) over (partition by user_id order by ts) as before"
    )
    naive.write.format("noop").mode("overwrite").save()
    assert most_read_by_a_task(spark, event_log, now) > ROWS["events"] / 4


def events_with(spark, folder, column, value):
    """The events of sf0.1, every third with this value in a column, in 16 files."""
    third = F.pmod(F.xxhash64("event_id", F.lit("again")), F.lit(3)) == 0
    df = table(spark, f"{TESTDATA}/sf0.1", "events")
    df = df.withColumn(column, F.when(third, value).otherwise(F.col(column)))
    if column == "ts":
        df = df.withColumn("user_id", F.when(third, F.lit(HOT)).otherwise(F.col("user_id")))
    df.repartition(16).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_hot_event_id_is_thinned(spark, small_tasks, event_log, tmp_path):
    sf_dir = events_with(spark, tmp_path, "event_id", F.lit(HOT).cast("bigint"))
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    df = QUERIES["stream_dedup"](spark, sf_dir)
    ids = table(spark, sf_dir, "events").select("event_id").distinct()
    assert df.count() == df.select("event_id").distinct().count() == ids.count()
    assert 0 < most_read_by_a_task(spark, event_log, now) < ROWS["events"] / 6


def test_a_burst_of_one_user_within_a_minute_is_spread(
    spark, small_tasks, event_log, tmp_path
):
    second = F.pmod(F.xxhash64("event_id", F.lit("s")), F.lit(60)).cast("int")
    ts = F.expr("timestamp_ntz'2024-01-10 12:00:00'") + F.make_dt_interval(secs=second)
    sf_dir = events_with(spark, tmp_path, "ts", ts)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    df = QUERIES["last_view_before_purchase"](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    assert 0 < most_read_by_a_task(spark, event_log, now) < ROWS["events"] / 6
    assert_same(df, duckdb_over(sf_dir), ORACLE_SQL["last_view_before_purchase"])


def test_hot_customer_is_split(spark, skewed, small_tasks):
    df = star.revenue_by_region_year(spark, skewed)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\) \[o_custkey", text)
