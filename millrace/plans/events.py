"""Queries over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import time_bucket
from millrace.operators.activity import rolling_distinct
from millrace.operators.aggregates import latest_per_key, sliding_counts, total_per_key
from millrace.operators.funnels import funnel
from millrace.operators.joins import last_before
from millrace.operators.overlaps import overlap_counts, peaks
from millrace.operators.sessions import sessionize
from millrace.sources.tables import table


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(time_bucket("ts", "1 hour").alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def events_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour-long window opening every 30 minutes."""
    events = table(spark, sf_dir, "events")
    counts = sliding_counts(events, "ts", "1 hour", "30 minutes")
    return counts.withColumnRenamed("n_rows", "n_events")


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, ended by a pause of more than 30 minutes."""
    sessions = sessionize(table(spark, sf_dir, "events"), "user_id", "ts", "30 minutes")
    return sessions.withColumnRenamed("n_rows", "n_events")


def overlapping_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each session the sessions of other users that overlap it."""
    # A user's own sessions never overlap each other.
    sessions = user_sessions(spark, sf_dir).drop("n_events")
    return overlap_counts(sessions, "session_start", "session_end")


def peak_open_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most sessions open at once on each day on which one starts or ends."""
    found = peaks(user_sessions(spark, sf_dir), "session_start", "session_end", "1 day")
    return found.withColumnsRenamed({"window_start": "day", "peak": "n_open"})


def weekly_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each day the users who did something on it or on the six days before."""
    found = rolling_distinct(table(spark, sf_dir, "events"), "user_id", "ts", 7)
    return found.withColumnRenamed("n_keys", "n_users")


def funnel_view_signup_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each user got from a view over a signup to a purchase, and how often."""
    kind = F.col("event_type")
    steps = [kind == step for step in ("view", "signup", "purchase")]
    return funnel(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", steps)


def last_view_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the same user's last view before it, if there is one."""
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events")
    found = last_before(
        events, "user_id", "ts", "event_id", kind == "view", kind == "purchase"
    )
    return found.withColumnsRenamed(
        {
            "event_id": "purchase_id",
            "ts": "purchase_ts",
            "source_id": "view_id",
            "source_ts": "view_ts",
        }
    )


def json_prop_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the JSON property ``k`` per event type; what is no integer is left out."""
    raw = F.get_json_object("props", "$.k")
    k = F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast("bigint"))
    return total_per_key(table(spark, sf_dir, "events"), "event_type", k, "total_k")


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of each user."""
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ["ts", "event_id"], ["event_type", "value"])
