"""Operators on hand-made and generated rows, against plain Python or the naive
Spark form, for what the tables lack: nulls, ties, exact gaps, hot keys."""

from __future__ import annotations

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import millrace.operators.quantiles as quantiles
from compare import rows_of
from conftest import START, at
from millrace.operators.aggregates import (
    count_cube,
    count_matrix,
    duplicate_keys,
    latest_per_key,
    sliding_counts,
)
from millrace.operators.joins import keys_in_first_only, last_before, rows_without_match
from millrace.operators.ranking import top_per_group
from millrace.operators.sessions import sessionize

EVENTS = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string"


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def random_events(n, seed, minutes=3000):
    """Two thirds of the users' rows even, a third on user 1; times repeat and some
    users and times are missing."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        user = 1 if rng.random() < 1 / 3 else rng.choice([None, *range(2, 12)])
        ts = None if rng.random() < 0.03 else at(rng.randrange(minutes))
        rows.append((event_id, user, ts, rng.choice(["view", "purchase", "click"])))
    return rows


# --- sessions ---------------------------------------------------------------


def test_session_gap_of_exactly_the_limit_stays_open(spark):
    minutes = [0, 30, 60.5, 90.5 + 1 / 60_000_000]
    rows = [(i, 7, at(m), "view") for i, m in enumerate(minutes)]
    got = collected(sessionize(spark.createDataFrame(rows, EVENTS), "user_id", "ts"))
    assert got == [
        (7, at(0), at(60), 2),
        (7, at(60.5), at(90.5), 1),
        (7, rows[3][2], rows[3][2] + (at(30) - at(0)), 1),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_equal_session_window(spark, seed):
    """Also for times before 1970, where rounding towards zero would go wrong."""
    rows = random_events(1500, seed)
    shifted = [
        (i + 10_000, u, None if t is None else t - (START - at(-60 * 24 * 20_000)), k)
        for i, u, t, k in rows
    ]
    df = spark.createDataFrame(rows + shifted, EVENTS).repartition(5)
    expected = (
        df.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s"))
        .agg(F.count("*").alias("n_rows"))
        .select(
            "user_id",
            F.col("s.start").alias("session_start"),
            F.col("s.end").alias("session_end"),
            "n_rows",
        )
    )
    assert rows_of(sessionize(df, "user_id", "ts")) == rows_of(expected)


# --- as-of ------------------------------------------------------------------


def last_view(rows, user, ts, event_id):
    earlier = [
        (t, i)
        for i, u, t, kind in rows
        if kind == "view" and u == user and t is not None and (t, i) < (ts, event_id)
    ]
    return max(earlier, default=(None, None))


@pytest.mark.parametrize(
    "chunk, piece",
    [
        ("1 minute", "1 minute"),
        ("15 minutes", "1 second"),
        ("1 hour", "5 minutes"),
        ("30 days", "1 minute"),
        ("30 days", "30 days"),
    ],
)
def test_last_before_equals_brute_force(spark, chunk, piece):
    rows = random_events(900, 3)
    expected = Counter()
    for i, user, ts, kind in rows:
        if kind == "purchase":
            known = user is not None and ts is not None
            seen, view = last_view(rows, user, ts, i) if known else (None, None)
            expected[(user, i, ts, view, seen)] += 1
    kind = F.col("event_type")
    got = last_before(
        spark.createDataFrame(rows, EVENTS).repartition(5),
        "user_id",
        "ts",
        "event_id",
        kind == "view",
        kind == "purchase",
        chunk,
        piece,
    )
    assert got.columns == ["user_id", "event_id", "ts", "source_id", "source_ts"]
    assert Counter(tuple(row) for row in got.collect()) == expected


def test_last_before_carries_over_empty_chunks(spark):
    rows = [
        (0, 1, at(0), "view"),
        (1, 1, at(1), "click"),
        (2, 1, at(5000), "purchase"),
        (3, 1, at(5000), "view"),
        (4, 1, at(5000), "purchase"),
        (5, 2, at(5000), "purchase"),
    ]
    kind = F.col("event_type")
    got = last_before(
        spark.createDataFrame(rows, EVENTS),
        "user_id",
        "ts",
        "event_id",
        kind == "view",
        kind == "purchase",
    )
    assert {row.event_id: row.source_id for row in got.collect()} == {2: 0, 4: 3, 5: None}


# --- quantiles --------------------------------------------------------------

FRACTIONS = {
    "low": Decimal("0"),
    "p10": Decimal("0.1"),
    "median": Decimal("0.5"),
    "p95": Decimal("0.95"),
    "top": Decimal("1"),
}


def quantile(cents, fraction):
    """By the definition, in exact arithmetic."""
    cents = sorted(cents)
    place = (len(cents) - 1) * Fraction(fraction)
    low = int(place)
    high = min(low + 1, len(cents) - 1)
    value = (cents[low] + (cents[high] - cents[low]) * (place - low)) / 100
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    return exact.quantize(Decimal("0.0001"), ROUND_HALF_UP)


def cents_by_group(seed):
    rng = random.Random(seed)
    return {
        # One price holds a third of a group.
        "hot": [rng.randrange(10**7) for _ in range(400)] + [4_999_99] * 200,
        "negative": [rng.randrange(-3 * 10**6, 10**6) for _ in range(301)],
        "wide": [rng.randrange(-(10**12) + 1, 10**12) for _ in range(200)],
        "one": [123],
        "two": [1, 2],
        "bands": [9_999, 10_000, 10_001, 99_999_999, 100_000_000],
        None: [5, 7, 7, 9],
    }


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_definition(spark, monkeypatch, broadcast, seed):
    if not broadcast:
        monkeypatch.setattr(quantiles, "broadcast_if_small", lambda df: None)
    groups = cents_by_group(seed)
    rows = [(g, Decimal(c) / 100) for g, cents in groups.items() for c in cents]
    rows += [("hot", None), ("empty", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, price decimal(12,2)").repartition(4)
    got = {
        row.g: tuple(row)[1:]
        for row in quantiles.exact_quantiles(df, "g", "price", FRACTIONS).collect()
    }
    expected = {
        g: tuple(quantile(cents, f) for f in FRACTIONS.values())
        for g, cents in groups.items()
    }
    expected["empty"] = (None,) * len(FRACTIONS)
    assert got == expected


# --- aggregations -----------------------------------------------------------


def test_sliding_counts_equal_sliding_window(spark):
    df = spark.createDataFrame(random_events(800, 5), EVENTS)
    expected = (
        df.groupBy(F.window("ts", "1 hour", "20 minutes").alias("w"))
        .agg(F.count("*").alias("n_rows"))
        .select(F.col("w.start").alias("window_start"), "n_rows")
    )
    got = sliding_counts(df, "ts", "1 hour", "20 minutes")
    assert rows_of(got) == rows_of(expected)


def test_sliding_counts_refuse_uneven_windows(spark):
    df = spark.createDataFrame(random_events(5, 1), EVENTS)
    with pytest.raises(ValueError, match="not a multiple"):
        sliding_counts(df, "ts", "1 hour", "25 minutes")


def test_count_cube_tells_null_keys_from_totals(spark):
    df = spark.createDataFrame(
        [("A", None), ("A", "F"), (None, "F"), (None, None)], "a string, b string"
    )
    plain = df.cube("a", "b").agg(
        F.grouping("a").cast("bigint").alias("a_total"),
        F.grouping("b").cast("bigint").alias("b_total"),
        F.count("*").alias("n_rows"),
    )
    assert rows_of(count_cube(df, ["a", "b"])) == rows_of(plain)
    assert sum(rows_of(plain).values()) == 9


def test_duplicate_keys_counts_copies(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert collected(duplicate_keys(df, ["a", "b"])) == sorted([(1, 1, 2), (None, 3, 2)], key=repr)


def test_latest_per_key_breaks_ties_by_the_next_column(spark):
    rows = [(3, 1, at(5), "a"), (9, 1, at(5), "b"), (4, 1, at(4), "c"), (5, 2, at(0), "d")]
    df = spark.createDataFrame(rows, EVENTS)
    got = latest_per_key(df, "user_id", ["ts", "event_id"], ["event_type"])
    assert collected(got) == [(1, at(5), 9, "b"), (2, at(0), 5, "d")]


def test_count_matrix_fills_missing_cells(spark):
    rows = [("x", "F"), ("x", "F"), ("y", "P"), ("y", "Q"), ("y", None)]
    df = spark.createDataFrame(rows, "p string, s string")
    got = count_matrix(df, "p", "s", {"F": "n_f", "O": "n_o", "P": "n_p"}, "n_other")
    assert collected(got) == [("x", 2, 0, 0, 0), ("y", 0, 0, 1, 2)]


def test_top_per_group_breaks_ties(spark):
    rows = [("a", i, v) for i, v in enumerate([5, 9, 9, 1])] + [("b", 0, 3)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = top_per_group(df, "g", [F.desc("v"), F.asc("id")], 2)
    assert collected(got) == [("a", 1, 9, 1), ("a", 2, 9, 2), ("b", 0, 3, 1)]


# --- keys -------------------------------------------------------------------


def test_rows_without_match_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "other int")
    got = rows_without_match(left, "k", right, "other")
    assert collected(got) == sorted([(2, "b"), (None, "c")], key=repr)


def test_keys_in_first_only_is_distinct(spark):
    first = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,)], "a int")
    second = spark.createDataFrame([(2,), (2,), (4,)], "b int")
    got = keys_in_first_only(first, "a", second, "b", "k")
    assert got.columns == ["k"]
    assert collected(got) == [(1,), (3,)]
