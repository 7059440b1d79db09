"""Operators on streams. ``ts`` must be a zoned timestamp; see ``as_instant``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.values import as_wall, interval


def stream_counts(stream: DataFrame, ts: str, width: str, delay: str) -> DataFrame:
    """Rows per window of ``width``: ``window_start, n_rows``.

    In append mode a window appears once the watermark, the latest time seen minus
    ``delay``, has reached its end.
    """
    counts = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("_window"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counts.select(as_wall("_window.start").alias("window_start"), "n_rows")


def stream_sessions(
    stream: DataFrame, key: str, ts: str, gap: str, delay: str
) -> DataFrame:
    """``key, session_start, session_end, n_rows``, each session once the watermark
    has reached its end."""
    sessions = (
        stream.withWatermark(ts, delay)
        .groupBy(key, F.session_window(ts, gap).alias("_session"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return sessions.select(
        key,
        as_wall("_session.start").alias("session_start"),
        as_wall("_session.end").alias("session_end"),
        "n_rows",
    )


def stream_followed(
    stream: DataFrame,
    key: str,
    ts: str,
    first: Column,
    then: Column,
    width: str,
    within: str,
    delay: str,
) -> DataFrame:
    """Rows that meet ``first`` and those of the same key that meet ``then`` in the same
    bucket of ``width`` or up to ``within`` later: ``key, first_start, n_first,
    then_start, n_then``, one row per pair of buckets.

    Both sides are counted per key and bucket before they meet, so a key with most of
    the rows brings a row per bucket, never a pair of rows; the state holds the buckets
    of the last ``within`` of each side. A pair appears once the watermark has reached
    the end of its later bucket. A first bucket that nothing follows (or without a key)
    appears with nulls once the watermark has passed the last bucket that could. Each
    side has a watermark and the earlier counts; a run that goes on where another stopped
    moves it once both sides have had rows.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        counts = (
            rows.withWatermark(ts, delay)
            .groupBy(key, F.window(ts, width).alias("_window"))
            .agg(F.count(F.lit(1)).alias(f"n_{name}"))
        )
        return counts.select(
            F.col(key).alias(f"_{name}_key"),
            F.window_time("_window").alias(f"_{name}_time"),
            F.col("_window.start").alias(f"_{name}_start"),
            f"n_{name}",
        )

    left = counted(stream.filter(first), "first")
    right = counted(stream.filter(then), "then")
    on = (
        (F.col("_first_key") == F.col("_then_key"))
        & (F.col("_then_time") >= F.col("_first_time"))
        & (F.col("_then_time") <= F.col("_first_time") + interval(within))
    )
    return left.join(right, on, "left").select(
        F.col("_first_key").alias(key),
        as_wall("_first_start").alias("first_start"),
        "n_first",
        as_wall("_then_start").alias("then_start"),
        "n_then",
    )


def stream_distinct(stream: DataFrame, row_id: str, ts: str, delay: str) -> DataFrame:
    """Rows whose ``row_id`` was not seen before, as long as copies arrive within
    ``delay`` of each other.

    Spark has no partial step for this before its shuffle, so each task first drops
    copies itself and keeps, of each id, the one with the latest time: that one is
    late only if all are, so no id is lost to the watermark. An id repeated in most
    of the rows crosses the shuffle once per task. The state then drops the remaining
    copies.
    """
    thinned = stream.mapInArrow(_latest_of_each(row_id, ts), stream.schema)
    return thinned.withWatermark(ts, delay).dropDuplicatesWithinWatermark([row_id])


# Rows that a task gathers before it thins them, and half of what it may carry on to the
# next ones; more are sent on and thinned anew. It bounds the task's memory and changes
# how many copies are left to the state, nothing else.
HELD_IDS = 50_000


def _latest_of_each(row_id: str, ts: str):
    """The latest row of each id (without a time only if no copy has one)."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n_waiting = None, [], 0

        def gathered() -> pa.Table:
            new = pa.Table.from_batches(waiting)
            return _thinned(new if held is None else pa.concat_tables([held, new]))

        for batch in batches:
            waiting.append(batch)
            n_waiting += batch.num_rows
            if n_waiting >= HELD_IDS:
                held, waiting, n_waiting = gathered(), [], 0
                if held.num_rows >= HELD_IDS // 2:
                    yield from held.to_batches()
                    held = None
        if waiting:
            held = gathered()
        if held is not None:
            yield from held.to_batches()

    def _thinned(rows: pa.Table) -> pa.Table:
        ids = rows.column(row_id).combine_chunks().dictionary_encode(null_encoding="encode")
        times = rows.column(ts).combine_chunks().cast(pa.int64()).fill_null(-(2**63))
        codes = ids.indices.to_numpy()
        order = np.lexsort((times.to_numpy(), codes))
        last = np.append(codes[order][1:] != codes[order][:-1], True)
        return rows.take(pa.array(np.sort(order[last]))) if len(order) else rows

    return thin


def stream_inactive(
    stream: DataFrame, key: str, ts: str, pause: str, delay: str, width: str = "1 hour"
) -> DataFrame:
    """``key, last_seen, n_rows``: a key that has had no row for longer than ``pause``
    after ``last_seen``, and its rows since it was last reported so. Rows without a key
    are left out. ``width`` must not be longer than ``pause``.

    Rows are first counted per key and bucket of ``width``, so a key with most of the
    rows brings a row per bucket. Buckets come in order of time, when the watermark has
    reached their end. The state of a key is its last time and a count, and a timer for
    the end of the bucket in which the pause is over; what the timer reports is deleted,
    so the state holds only keys that were active within the pause.
    """
    if pd.Timedelta(width) > pd.Timedelta(pause):
        raise ValueError(f"{width} is longer than {pause}")
    buckets = (
        stream.filter(F.col(key).isNotNull())
        .withWatermark(ts, delay)
        .groupBy(key, F.window(ts, width).alias("_window"))
        .agg(
            F.unix_micros(F.min(ts)).alias("_first"),
            F.unix_micros(F.max(ts)).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(key, F.window_time("_window").alias("_time"), "_first", "_last", "_n")
    )
    kind = stream.schema[key].dataType.simpleString()
    found = buckets.groupBy(key).transformWithState(
        statefulProcessor=_Pauses(key, _micros(pause), _micros(width)),
        outputStructType=f"{key} {kind}, _last bigint, n_rows bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    seen = as_wall(F.timestamp_micros("_last"))
    return found.select(key, seen.alias("last_seen"), "n_rows")


def _micros(length: str) -> int:
    return pd.Timedelta(length) // pd.Timedelta("1us")


class _Pauses(StatefulProcessor):
    """See ``stream_inactive``; times are microseconds."""

    def __init__(self, key: str, pause: int, width: int) -> None:
        self.key, self.pause, self.width = key, pause, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        last, n = before = self.seen.get() if self.seen.exists() else (None, 0)
        for row in sorted(rows, key=lambda row: row["_first"]):
            if last is not None and row["_first"] - last > self.pause:
                yield Row(**{self.key: key[0], "_last": last, "n_rows": n})
                n = 0
            last, n = row["_last"], n + row["_n"]
        if before[0] is not None:
            self.handle.deleteTimer(self._over(before[0]))
        self.seen.update((last, n))
        self.handle.registerTimer(self._over(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        last, n = self.seen.get()
        self.seen.clear()
        yield Row(**{self.key: key[0], "_last": last, "n_rows": n})

    def close(self) -> None:
        pass

    def _over(self, last: int) -> int:
        """The millisecond before the end of the bucket that holds the end of the pause:
        timers go off when the watermark is past them, and until it has reached that end
        there may be rows to come from before the pause is over."""
        return ((last + self.pause) // self.width + 1) * self.width // 1000 - 1
