"""Streams over several micro-batches: lateness, copies, restarts, time zones."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from compare import rows_of
from conftest import TESTDATA, at
from millrace.functions.values import as_instant, as_wall
from millrace.sources.tables import BY_SIZE, table, table_stream
from millrace.streaming.operators import (
    stream_counts,
    stream_distinct,
    stream_followed,
    stream_inactive,
    stream_sessions,
)
from millrace.plans import streams
from millrace.streaming import operators as streaming_operators
from millrace.streaming import run as streaming_run
from millrace.streaming.run import LateRows, run_available

SCHEMA = "event_id bigint, user_id bigint, ts timestamp_ntz"


class Feed:
    """A table that grows by one file per ``send``, read as a stream."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def send(self, *rows):
        df = self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{self.folder}/events.parquet")

    def run(self, operator, allow_late=False):
        stream = table_stream(self.spark, str(self.folder), "events", files_per_batch=1)
        result = operator(stream.select("event_id", "user_id", as_instant("ts").alias("ts")))
        folders = f"{self.folder}/table", f"{self.folder}/checkpoint"
        return run_available(result, *folders, allow_late=allow_late)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_late_events_within_the_delay_count_and_later_ones_do_not(feed):
    def hourly(stream):
        return stream_counts(stream, "ts", "1 hour", "10 minutes")

    feed.send((1, 1, at(10)), (2, 1, at(65)))
    assert rows(feed.run(hourly)) == []
    feed.send((3, 1, at(50)))  # late, but hour 0 closes at minute 70
    feed.send((4, 1, at(75)))
    assert rows(feed.run(hourly)) == [(at(0), 2)]
    feed.send((5, 1, at(55)))  # hour 0 is closed
    feed.send((6, 1, at(200)))
    assert rows(feed.run(hourly, allow_late=True)) == [(at(0), 2), (at(60), 2)]


def test_sessions_join_across_batches(feed):
    def sessions(stream):
        return stream_sessions(stream, "user_id", "ts", "30 minutes", "10 minutes")

    feed.send((1, 1, at(0)), (2, 2, at(3)))
    feed.send((3, 1, at(30)))  # exactly the gap
    feed.send((4, 1, at(55)), (5, 3, at(130)))
    assert rows(feed.run(sessions)) == [
        (1, at(0), at(85), 3),
        (2, at(3), at(33), 1),
    ]


def test_copies_are_dropped_within_and_across_batches_and_runs(feed):
    def distinct(stream):
        kept = stream_distinct(stream, "event_id", "ts", "10 minutes")
        return kept.withColumn("ts", as_wall("ts"))

    hot = [(1, 1, at(0))] * 500
    feed.send(*hot, (2, 1, at(1)), *hot)
    feed.send((2, 1, at(1)), (3, 1, at(2)))
    assert rows(feed.run(distinct)) == [(1, 1, at(0)), (2, 1, at(1)), (3, 1, at(2))]
    feed.send((1, 1, at(0)), (3, 1, at(2)), (4, 1, at(3)))
    got = rows(feed.run(distinct))
    assert [row[0] for row in got] == [1, 2, 3, 4]


def test_null_ids_are_copies_of_each_other(feed):
    def distinct(stream):
        return stream_distinct(stream, "event_id", "ts", "10 minutes")

    feed.send((None, 1, at(0)), (7, 1, at(0)), (None, 2, at(0)))
    assert sorted(row.event_id or 0 for row in feed.run(distinct).collect()) == [0, 7]


def test_running_again_adds_nothing(feed):
    def hourly(stream):
        return stream_counts(stream, "ts", "1 hour", "10 minutes")

    feed.send((1, 1, at(10)), (2, 1, at(200)))
    assert rows(feed.run(hourly)) == [(at(0), 1)]
    assert rows(feed.run(hourly)) == [(at(0), 1)]


def test_a_failed_run_is_taken_up_again(feed):
    """The first batch is done, the second fails; the next run does the second only."""

    def distinct(stream):
        return stream_distinct(stream, "event_id", "ts", "10 minutes").withColumn(
            "ts", as_wall("ts")
        )

    def failing(stream):
        bad = F.when(F.col("event_id") == 99, F.raise_error(F.lit("lost"))).cast("bigint")
        return distinct(stream.withColumn("user_id", F.coalesce(bad, "user_id")))

    feed.send((1, 1, at(0)), (2, 1, at(1)))
    feed.run(failing)
    feed.send((2, 1, at(1)), (99, 1, at(2)))
    with pytest.raises(StreamingQueryException, match="lost"):
        feed.run(failing)
    got = [row[0] for row in rows(feed.run(distinct))]
    assert got == [1, 2, 99]


def test_settings_are_put_back(spark, feed):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    feed.send((1, 1, at(10)))
    feed.run(lambda stream: stream_counts(stream, "ts", "1 hour", "10 minutes"))
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kathmandu"])
def test_wall_time_survives_the_zone(spark, conf, zone):
    """The first two times fall into a night when clocks in Sao Paulo were moved."""
    conf("spark.sql.session.timeZone", zone)
    df = spark.sql(
        """select * from values (timestamp_ntz'2018-11-04 00:30:00.123456'),
           (timestamp_ntz'2018-02-17 23:30:00'), (timestamp_ntz'1969-12-31 23:59:59.999999'),
           (timestamp_ntz'2024-01-01 00:00:00'), (null) as t(ts)"""
    )
    back = df.select("ts", as_wall(as_instant("ts")).alias("back"))
    assert back.filter(~F.col("ts").eqNullSafe(F.col("back"))).count() == 0


def test_hours_start_on_the_hour_in_any_zone(spark, conf, feed):
    conf("spark.sql.session.timeZone", "Asia/Kathmandu")
    feed.send((1, 1, at(59)), (2, 1, at(60)), (3, 1, at(500)))
    got = feed.run(lambda stream: stream_counts(stream, "ts", "1 hour", "10 minutes"))
    assert rows(got) == [(at(0), 1), (at(60), 1)]


def test_stream_of_many_files_equals_batch(spark, tmp_path):
    """One file per batch, in time order: the same closed hours as from one batch."""
    events = table(spark, f"{TESTDATA}/sf0.001", "events")
    ordered = events.orderBy("ts").collect()
    size = len(ordered) // 4 + 1
    for start in range(0, len(ordered), size):
        part = spark.createDataFrame(ordered[start : start + size], events.schema)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    stream = table_stream(spark, str(tmp_path), "events", files_per_batch=1)
    counts = stream_counts(stream.withColumn("ts", as_instant("ts")), "ts", "1 hour", "10 minutes")
    got = run_available(counts, f"{tmp_path}/t", f"{tmp_path}/c")
    closed = ordered[-1].ts - timedelta(minutes=10)
    expected = (
        events.groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count("*").alias("n_rows"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("e"), "n_rows")
        .filter(F.col("e") <= F.lit(str(closed)).cast("timestamp_ntz"))
        .drop("e")
    )
    assert rows_of(got) == rows_of(expected)


def distinct_ids(stream):
    return stream_distinct(stream, "event_id", "ts", "10 minutes").withColumn(
        "ts", as_wall("ts")
    )


def test_an_id_whose_first_copy_is_late_is_kept(feed):
    feed.send((1, 1, at(300)))
    feed.run(distinct_ids)
    feed.send((5, 1, at(10)), (5, 1, at(310)))
    got = feed.run(distinct_ids, allow_late=True)
    assert sorted(row.event_id for row in got.collect()) == [1, 5]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_thinning_keeps_the_ids_that_spark_keeps(spark, feed, monkeypatch, seed):
    monkeypatch.setattr(streaming_operators, "HELD_IDS", 7)
    rng = random.Random(seed)
    for start in (0, 40, 25, 90, 10):
        batch = [
            (rng.choice([None, *range(30)]), rng.randrange(3), at(start + rng.randrange(60)))
            for _ in range(80)
        ]
        feed.send(*batch)
    kept = feed.run(distinct_ids, allow_late=True)

    def plain(stream):
        kept = stream.withWatermark("ts", "10 minutes")
        return kept.dropDuplicatesWithinWatermark(["event_id"]).withColumn("ts", as_wall("ts"))

    stream = table_stream(spark, str(feed.folder), "events", files_per_batch=1)
    stream = stream.select("event_id", "user_id", as_instant("ts").alias("ts"))
    expected = run_available(
        plain(stream), f"{feed.folder}/t2", f"{feed.folder}/c2", allow_late=True
    )
    ids = lambda df: {row.event_id for row in df.collect()}
    assert ids(kept) == ids(expected)


def write_files(spark, folder, name, count, backwards=False):
    """The events of sf0.01 in files that follow each other in time, or do not."""
    rows = table(spark, f"{TESTDATA}/sf0.01", "events").orderBy("ts").collect()
    size = len(rows) // count + 1
    starts = list(range(0, len(rows), size))
    schema = table(spark, f"{TESTDATA}/sf0.01", "events").schema
    for start in reversed(starts) if backwards else starts:
        part = spark.createDataFrame(rows[start : start + size], schema)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")
    return len(rows)


STREAMS = [
    "stream_events_hourly",
    "stream_user_sessions",
    "stream_dedup",
    "stream_view_to_purchase",
]


@pytest.mark.parametrize("name", STREAMS)
def test_batches_in_time_order_equal_one_batch(spark, tmp_path, name, monkeypatch):
    """And the state does not hold the whole backlog."""
    held = []
    count = streaming_run.rows_dropped
    monkeypatch.setattr(
        streaming_run,
        "rows_dropped",
        lambda progress: held.append(progress) or count(progress),
    )
    monkeypatch.setitem(
        streaming_run._STATE,
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows",
        "true",
    )
    total = write_files(spark, tmp_path, "events", 8)
    query = getattr(streams, name)
    expected = rows_of(query(spark, str(tmp_path), files_per_batch=None))
    assert rows_of(query(spark, str(tmp_path), files_per_batch=1)) == expected
    peak = max(
        operator["numRowsTotal"] for batch in held[-1] for operator in batch["stateOperators"]
    )
    assert len(held[-1]) >= 8
    assert peak < total / 3


def test_files_out_of_order_fail_loudly(spark, tmp_path):
    write_files(spark, tmp_path, "events", 4, backwards=True)
    with pytest.raises(LateRows, match="too late"):
        streams.stream_events_hourly(spark, str(tmp_path), files_per_batch=1)
    streams.stream_events_hourly(spark, str(tmp_path), files_per_batch=None)


def test_small_files_make_few_batches(spark, tmp_path, monkeypatch):
    """Batches follow the bytes of the files, not their number."""
    seen = []
    monkeypatch.setattr(streaming_run, "rows_dropped", lambda progress: seen.append(progress) or 0)
    events = table(spark, f"{TESTDATA}/sf0.001", "events")
    events.repartition(300).write.parquet(f"{tmp_path}/events.parquet")
    got = streams.stream_dedup(spark, str(tmp_path), files_per_batch=BY_SIZE)
    assert got.count() == events.count()
    assert sum(batch["numInputRows"] > 0 for batch in seen[-1]) == 1


def test_more_batches_than_are_remembered_fail_loudly(feed, monkeypatch):
    """Else rows dropped in a forgotten batch would go unnoticed."""
    monkeypatch.setitem(streaming_run._STATE, "spark.sql.streaming.numRecentProgressUpdates", "2")
    for minute in (0, 100, 200, 300):
        feed.send((minute, 1, at(minute)))
    with pytest.raises(LateRows, match="more batches"):
        feed.run(lambda stream: stream_counts(stream, "ts", "1 hour", "10 minutes"))


def followed(stream):
    """Events with an id below 100 are the first ones."""
    first = F.col("event_id") < 100
    found = stream_followed(
        stream, "user_id", "ts", first, ~first, "1 minute", "30 minutes", "10 minutes"
    )
    return found.select("user_id", "first_start", "n_first", "then_start", "n_then")


def some(rows):
    return sorted(rows, key=lambda row: tuple(str(x) for x in row))


def test_pairs_and_outer_rows_appear_when_the_watermark_has_passed(feed):
    feed.send((1, 1, at(0)), (2, 1, at(0.5)), (3, 2, at(0)), (4, None, at(0)), (100, None, at(1)))
    assert feed.run(followed).count() == 0
    # The last minute that still follows, the first that no longer does.
    feed.send((100, 1, at(30.9)), (101, 2, at(31)), (5, 3, at(31)))
    assert feed.run(followed).count() == 0
    # Both sides have come to minute 40.9: minute 30 is not quite over.
    feed.send((102, 4, at(40.9)), (6, 4, at(45)))
    assert feed.run(followed).count() == 0
    feed.send((103, 4, at(41)), (9, 4, at(46)))
    closed = [(1, at(0), 2, at(30), 1)]
    assert some(feed.run(followed).collect()) == some(closed)
    # Outer rows wait for the next millisecond.
    feed.send((103, 4, at(41) + timedelta(milliseconds=1)), (9, 4, at(46)))
    closed += [(2, at(0), 1, None, None), (None, at(0), 1, None, None)]
    assert some(feed.run(followed).collect()) == some(closed)
    # Late, but within the delay; the later of the two sides does not close anything.
    feed.send((7, 2, at(32)), (104, 2, at(33)), (8, 9, at(500)))
    feed.send((105, 9, at(46)))
    closed += [
        (2, at(32), 1, at(33), 1),
    ]
    assert some(feed.run(followed).collect()) == some(closed)


@pytest.mark.parametrize("seed", [1, 2])
def test_followed_rows_of_a_hot_user_equal_brute_force(feed, seed):
    """A third of all rows are one user's; rows repeat, some come late within the delay,
    and runs end between batches."""
    rng = random.Random(seed)
    everything = []
    for batch in range(6):
        start = batch * 40
        sent = [
            (
                rng.randrange(200),
                rng.choice([7, rng.randrange(20), None]),
                at(start + rng.randrange(-5 * 60, 40 * 60) / 60),
            )
            for _ in range(150)
        ]
        sent += sent[:10] + [(1, 0, at(start + 40)), (150, 0, at(start + 40))]
        everything += sent
        feed.send(*sent)
        if batch % 2:
            got = feed.run(followed)
    minutes = {}
    for event, user, ts in everything:
        place = (event < 100, user, ts.replace(second=0, microsecond=0))
        minutes[place] = minutes.get(place, 0) + 1
    closed = at(5 * 40 + 40 - 10)
    expected = []
    for (is_first, user, minute), n in minutes.items():
        if not is_first:
            continue
        later = [minute + timedelta(minutes=m) for m in range(31)]
        after = [(t, minutes[False, user, t]) for t in later if (False, user, t) in minutes]
        if user is None or not after:
            after = [(None, None)]
        for t, count in after:
            end = (t or later[-1]) + timedelta(minutes=1)
            if end < closed or (t and end == closed):
                expected.append((user, minute, n, t, count))
    assert some(got.collect()) == some(expected)
    assert len(expected) > 100


def inactive(stream):
    return stream_inactive(stream, "user_id", "ts", "2 hours", "10 minutes")


def test_a_pause_is_reported_once_and_its_state_deleted(feed):
    feed.send((1, 1, at(5)), (2, 1, at(65)), (3, 2, at(70)))
    # User 1 is back after exactly the pause, user 2 after more; both in one batch with it.
    feed.send((4, 1, at(185)), (5, 2, at(191)), (6, None, at(192)))
    assert rows(feed.run(inactive)) == []
    # The buckets up to minute 240 are over; user 2's pause ended within that of 190.
    feed.send((7, 3, at(255)))
    assert rows(feed.run(inactive)) == [(2, at(70), 1)]
    # Started again from the checkpoint: user 1's pause is over at 305, its bucket at 360.
    feed.send((8, 3, at(369)))
    assert rows(feed.run(inactive)) == [(2, at(70), 1)]
    feed.send((9, 3, at(371)))
    assert rows(feed.run(inactive)) == [(1, at(185), 3), (2, at(70), 1), (2, at(191), 1)]
    # Who comes back after a report is counted anew.
    feed.send((10, 1, at(400)), (11, 3, at(2000)))
    assert (1, at(400), 1) in rows(feed.run(inactive))


def test_pauses_do_not_depend_on_batches(spark, tmp_path):
    rng = random.Random(8)
    times = sorted(rng.randint(0, 6000) for _ in range(400))
    events = [(i, rng.choice([7, 7, *range(6)]), at(t)) for i, t in enumerate(times)]
    found = []
    for n in (1, 4, 12):
        folder = tmp_path / str(n)
        feed = Feed(spark, folder)
        size = -(-len(events) // n)
        for start in range(0, len(events), size):
            feed.send(*events[start : start + size])
            if n < 12:
                feed.run(inactive)
        found.append(rows(feed.run(inactive)))
    assert found[0] == found[1] == found[2]
    closed = (at(times[-1]) - at(0)).total_seconds() / 60 - 10
    expected = []
    for user in {u for _, u, _ in events}:
        mine = [e[2] for e in events if e[1] == user]
        n = 0
        for t, then in zip(mine, [*mine[1:], None]):
            n += 1
            over = (t - at(0)).total_seconds() // 60 + 120
            if (then is None or then - t > timedelta(hours=2)) and (over // 60 + 1) * 60 <= closed:
                expected.append((user, t, n))
            if then is not None and then - t > timedelta(hours=2):
                n = 0
    assert found[0] == sorted(expected)


def test_a_bucket_is_not_longer_than_the_pause(feed):
    feed.send((1, 1, at(5)))
    with pytest.raises(ValueError, match="longer"):
        feed.run(lambda stream: stream_inactive(stream, "user_id", "ts", "30 minutes", "1 minute"))
