"""Intervals that overlap, by counting starts and ends instead of forming pairs.

Of ``n`` intervals ``[start, end)`` those that overlap ``[s, e)`` are the ones that start
before ``e``, less the ones that have ended by ``s``. Both are sums over everything that
comes before a time, so a busy hour costs no more than any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import time_bucket
from millrace.operators.running import sums_before
from millrace.sources.shared import checkpointed


def _points(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``at, starts, ends``: all end points of the intervals and how many there are."""
    is_start, is_end = F.lit(1), F.lit(0)
    both = F.array(
        F.struct(F.col(start).alias("at"), is_start.alias("starts"), is_end.alias("ends")),
        F.struct(F.col(end).alias("at"), is_end.alias("starts"), is_start.alias("ends")),
    )
    return intervals.select(F.inline(both))


def overlap_counts(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``intervals`` with ``n_overlapping``: the other intervals that share some time with
    each. One that ends when another starts does not overlap it. Intervals without both
    times, or that do not end after they start, are left out."""
    known = checkpointed(intervals.filter(F.col(start) < F.col(end)))
    points, _ = sums_before(_points(known, start, end), ["at"], ["starts", "ends"])
    points = checkpointed(points)
    started = points.select(F.col("at").alias(end), F.col("before_starts").alias("_started"))
    ended = points.select(
        F.col("at").alias(start), (F.col("before_ends") + F.col("ends")).alias("_ended")
    )
    return (
        known.join(started, end)
        .join(ended, start)
        .select(*known.columns, (F.col("_started") - F.col("_ended") - 1).alias("n_overlapping"))
    )


def peaks(intervals: DataFrame, start: str, end: str, length: str = "1 day") -> DataFrame:
    """``window_start, peak``: the most intervals that are open at once in each window in
    which one starts or ends. Intervals without both times, or that do not end after they
    start, are left out."""
    known = intervals.filter(F.col(start) < F.col(end))
    points, _ = sums_before(_points(known, start, end), ["at"], ["starts", "ends"])
    before = F.col("before_starts") - F.col("before_ends")
    after = before + F.col("starts") - F.col("ends")
    window = time_bucket("at", length)
    # What was open before counts where the window had begun by then.
    most = F.greatest(after, F.when(F.col("at") > window, before).otherwise(after))
    return points.groupBy(window.alias("window_start")).agg(F.max(most).alias("peak"))
