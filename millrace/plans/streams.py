"""Queries that run the event table through Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import as_instant, as_wall, hundredths
from millrace.sources.tables import BY_SIZE, table_stream
from millrace.streaming.operators import (
    stream_counts,
    stream_distinct,
    stream_followed,
    stream_inactive,
    stream_sessions,
)
from millrace.streaming.run import run_once
from millrace.streaming.totals import totals_once

DELAY = "10 minutes"
VIEW_TO_PURCHASE = "30 minutes"
INACTIVE = "2 days"


def stream_events_hourly(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """Events per hour, for the hours the watermark has passed."""
    events = _events(spark, sf_dir, files_per_batch)
    counts = stream_counts(events, "ts", "1 hour", DELAY)
    named = counts.withColumnRenamed("n_rows", "n_events")
    return run_once(named, "stream_events_hourly")


def stream_user_sessions(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """Sessions of each user, for those the watermark has passed."""
    events = _events(spark, sf_dir, files_per_batch)
    sessions = stream_sessions(events, "user_id", "ts", "30 minutes", DELAY)
    named = sessions.withColumnRenamed("n_rows", "n_events")
    return run_once(named, "stream_user_sessions")


def stream_dedup(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """The event stream delivered twice, each event kept once."""
    twice = _events(spark, sf_dir, files_per_batch).unionByName(
        _events(spark, sf_dir, files_per_batch)
    )
    kept = stream_distinct(
        twice.select("event_id", "ts", "user_id", "event_type", "value"),
        "event_id",
        "ts",
        DELAY,
    )
    return run_once(kept.withColumn("ts", as_wall("ts")), "stream_dedup")


def stream_view_to_purchase(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """Views of each user and minute beside the user's purchases of each minute up to
    30 minutes later; nulls for those that no purchase follows."""
    followed = stream_followed(
        _events(spark, sf_dir, files_per_batch),
        "user_id",
        "ts",
        F.col("event_type") == "view",
        F.col("event_type") == "purchase",
        "1 minute",
        VIEW_TO_PURCHASE,
        DELAY,
    )
    named = followed.withColumnsRenamed(
        {
            "first_start": "view_minute",
            "n_first": "n_views",
            "then_start": "purchase_minute",
            "n_then": "n_purchases",
        }
    )
    return run_once(named, "stream_view_to_purchase")


def stream_inactive_users(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """Users who did nothing for more than two days, from the last thing they did."""
    events = _events(spark, sf_dir, files_per_batch)
    inactive = stream_inactive(events, "user_id", "ts", INACTIVE, DELAY)
    named = inactive.withColumnRenamed("n_rows", "n_events")
    return run_once(named, "stream_inactive_users")


def stream_revenue_upserts(
    spark: SparkSession, sf_dir: str, files_per_batch: int | str | None = BY_SIZE
) -> DataFrame:
    """Order lines and their prices per month of shipping; every line is added, and one
    that was returned is removed again."""

    def lines(sign: int) -> DataFrame:
        rows = table_stream(spark, sf_dir, "lineitem", files_per_batch)
        rows = rows if sign > 0 else rows.filter(F.col("l_returnflag") == "R")
        month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
        return rows.select(month.alias("ship_month"), "l_extendedprice", F.lit(sign).alias("sign"))

    changes = lines(1).unionByName(lines(-1))
    price = hundredths("l_extendedprice")
    found = totals_once(changes, ["ship_month"], "sign", price, "stream_revenue_upserts")
    return found.withColumnsRenamed({"n_rows": "n_lines", "total": "revenue"})


def _events(spark: SparkSession, sf_dir: str, files_per_batch: int | str | None) -> DataFrame:
    events = table_stream(spark, sf_dir, "events", files_per_batch)
    return events.withColumn("ts", as_instant("ts"))
