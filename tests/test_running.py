"""Running sums, ranks, overlaps and peaks: against brute force, with hot keys."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import START
from millrace.operators.overlaps import overlap_counts, peaks
from millrace.operators.running import percentiles, sums_before


def test_sums_before_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([5] * 30 + list(range(60))), rng.randint(-3, 9)) for _ in range(900)]
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    found, totals = sums_before(df, ["k"], ["v"])
    expected = {
        k: (sum(v for x, v in rows if x == k), sum(v for x, v in rows if x < k)) for k, _ in rows
    }
    assert {row["k"]: (row["v"], row["before_v"]) for row in found.collect()} == expected
    assert totals == {"v": sum(v for _, v in rows)}


def test_nothing_to_sum(spark):
    empty = spark.createDataFrame([], "k bigint, v bigint")
    found, totals = sums_before(empty, ["k"], ["v"])
    assert found.count() == 0 and totals == {"v": 0}
    assert percentiles(empty, "v", "k").count() == 0


def brute_percentiles(rows, buckets):
    known = sorted(((v, k is not None, k or 0, k) for k, v in rows if v is not None), key=lambda x: x[:3])
    n = len(known)
    small, larger = divmod(n, buckets)
    sizes = [small + (i < larger) for i in range(buckets)]
    bucket_of = [i + 1 for i, size in enumerate(sizes) for _ in range(size)]
    out = []
    for at, (v, _, _, k) in enumerate(known):
        less = sum(x[0] < v for x in known)
        out.append((k, v, less + 1, less / max(n - 1, 1), bucket_of[at]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,buckets", [(1, 100), (57, 100), (500, 100), (503, 7)])
def test_percentiles_equal_brute_force(spark, n, buckets):
    """A third of the rows on one value, nulls, and rows that repeat value and key."""
    rng = random.Random(n)
    rows = [(i, 7.5 if i % 3 == 0 else float(rng.randint(0, 40))) for i in range(n)]
    rows += [(3, 7.5)] * 4 + [(None, 7.5)] * 2 + [(9, None)] * 2
    df = spark.createDataFrame(rows, "k bigint, v double").repartition(4)
    found = sorted(map(tuple, percentiles(df, "v", "k", buckets).collect()), key=str)
    assert found == brute_percentiles(rows, buckets)


def some_intervals(n):
    """A third start in one minute, a few lie end to end, some are not intervals."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        start = START + timedelta(minutes=600 if i % 3 == 0 else rng.randint(0, 4000))
        rows.append((i, start, start + timedelta(minutes=rng.choice([1, 30, 30, 200, 2000]))))
    rows += [(-1, None, START), (-2, START, None), (-3, START, START), (-4, rows[1][2], rows[1][1])]
    return rows


SCHEMA = "k bigint, s timestamp_ntz, e timestamp_ntz"


def test_overlaps_equal_brute_force(spark):
    rows = some_intervals(400)
    found = overlap_counts(spark.createDataFrame(rows, SCHEMA), "s", "e")
    assert found.columns == ["k", "s", "e", "n_overlapping"]
    known = [row for row in rows if row[1] and row[2] and row[1] < row[2]]
    expected = {k: sum(s < e2 and s2 < e for _, s2, e2 in known) - 1 for k, s, e in known}
    assert {row["k"]: row["n_overlapping"] for row in found.collect()} == expected


def test_peaks_equal_brute_force(spark):
    rows = some_intervals(300)
    # Open through midnight and ending later that day; starting exactly at midnight.
    rows += [(900, START + timedelta(hours=23), START + timedelta(hours=25))] * 3
    rows += [(901, START + timedelta(days=2), START + timedelta(days=2, minutes=1))]
    found = peaks(spark.createDataFrame(rows, SCHEMA), "s", "e")
    known = [(s, e) for _, s, e in rows if s and e and s < e]
    days = {}
    for at in {t for pair in known for t in pair}:
        day = at.replace(hour=0, minute=0)
        moments = [at] + ([at - timedelta(microseconds=1)] if at > day else [])
        most = max(sum(s <= t < e for s, e in known) for t in moments)
        days[day] = max(days.get(day, 0), most)
    assert {row["window_start"]: row["peak"] for row in found.collect()} == days


def test_a_hot_time_is_spread(spark, conf):
    """No task reads more than a sixth of the intervals, pairs are never made."""
    conf("spark.sql.shuffle.partitions", "16")
    rows = spark.range(60_000).select(
        F.col("id").alias("k"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0, if(id % 3 = 0, 36000, id))").alias("s"),
    )
    rows = rows.withColumn("e", F.expr("s + interval 30 minutes"))
    found = overlap_counts(rows, "s", "e")
    hot = found.filter("k % 3 = 0").agg(F.min("n_overlapping"), F.max("n_overlapping")).first()
    times = [36000 if i % 3 == 0 else i for i in range(60_000)]
    assert tuple(hot) == (sum(abs(t - 36000) < 1800 for t in times) - 1,) * 2
    assert found.count() == 60_000
