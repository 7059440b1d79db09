"""Distinct keys over a rolling number of days, without copying rows into windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import interval, time_bucket
from millrace.operators.running import sums_before


def rolling_distinct(df: DataFrame, key: str, ts: str, days: int) -> DataFrame:
    """``day, n_keys``: how many keys have a row on that day or the ``days - 1`` before
    it, for each day that has a row. Rows without a key or a time are left out.

    A key counts from a day on which it has a row until ``days`` later; runs of such days
    that touch or overlap are merged into one interval, so that nothing is counted twice.
    What is shuffled is one row per key, day and task, and the days' counts are a running
    sum over where intervals start and end.
    """
    if days < 1:
        raise ValueError("a window has at least one day")
    active = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, time_bucket(ts, "1 day").alias("day"))
        .agg(F.lit(1).alias("_seen"))
    )
    in_order = Window.partitionBy(key).orderBy("day")
    length = interval(f"{days} days")
    until = F.col("day") + length
    starts = F.coalesce(F.lag("day").over(in_order) + length < F.col("day"), F.lit(True))
    ends = F.coalesce(F.lead("day").over(in_order) > until, F.lit(True))
    merged = active.select(key, "day", starts.alias("_starts"), ends.alias("_ends"))
    point = F.struct(
        F.col("day"),
        F.col("_starts").cast("int").alias("step"),
        F.lit(1).alias("n_rows"),
    )
    end = F.struct(until.alias("day"), F.lit(-1).alias("step"), F.lit(0).alias("n_rows"))
    points = merged.select(F.inline(F.array_compact(F.array(point, F.when(F.col("_ends"), end)))))
    sums, _ = sums_before(points, ["day"], ["step", "n_rows"])
    return sums.filter(F.col("n_rows") > 0).select(
        "day", (F.col("before_step") + F.col("step")).alias("n_keys")
    )
