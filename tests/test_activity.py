"""Rolling distinct keys and funnels: against brute force, with hot keys and odd rows."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import START
from millrace.operators.activity import rolling_distinct
from millrace.operators.funnels import funnel

SCHEMA = "id bigint, k string, t timestamp_ntz, kind string"
KINDS = ["view", "signup", "purchase"]


def some_rows(n, seed):
    """Half of the rows on one key, a tenth at one time, and rows without key or time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = START + timedelta(seconds=rng.choice([5000] + [rng.randint(0, 9 * 86400)] * 9))
        key = "hot" if i % 2 else rng.choice("abcdefgh")
        rows.append((i, key, t, rng.choice([*KINDS, "click", None])))
    rows += [(n, None, START, "view"), (n + 1, "a", None, "view"), (n + 2, "only", None, "view")]
    return [*rows, *rows[:5]]


@pytest.mark.parametrize("days", [1, 2, 7])
def test_rolling_distinct_equals_brute_force(spark, days):
    rng = random.Random(days)
    rows = [row for row in some_rows(120, days) if row[2] is None or rng.random() < 0.5]
    # A far day, so that some days have no row, and one just as far away as a window.
    rows += [(900, "a", START + timedelta(days=30), "view")]
    rows += [(901, "b", START + timedelta(days=30 + days), "view")]
    found = rolling_distinct(spark.createDataFrame(rows, SCHEMA), "k", "t", days)
    seen = {(k, t.replace(hour=0, minute=0, second=0)) for _, k, t, _ in rows if k and t}
    expected = {
        day: len({k for k, d in seen if timedelta(0) <= day - d < timedelta(days=days)})
        for _, day in seen
    }
    assert {row["day"]: row["n_keys"] for row in found.collect()} == expected


def brute_funnel(rows):
    found = {}
    known = [(t, i, KINDS.index(kind), k) for i, k, t, kind in rows if k and t and kind in KINDS]
    for _, _, step, key in sorted(known):
        n = found.get(key, 0)
        found[key] = n + (n % 3 == step)
    return {key: (min(n, 3), n // 3) for key, n in found.items()}


@pytest.mark.parametrize(
    "pieces", [(), ("1 second",), ("1 minute", "1 day"), ("7 minutes", "1 hour", "5 days")]
)
def test_funnels_equal_brute_force_whatever_the_pieces(spark, pieces):
    rows = some_rows(700, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    steps = [F.col("kind") == kind for kind in KINDS]
    found = funnel(df, "k", "t", "id", steps, pieces)
    assert found.columns == ["k", "n_steps", "n_complete"]
    got = {row["k"]: (row["n_steps"], row["n_complete"]) for row in found.collect()}
    assert got == brute_funnel(rows) and got["hot"][1] > 20


def test_one_step_counts_its_rows(spark):
    df = spark.createDataFrame(some_rows(60, 5), SCHEMA)
    found = funnel(df, "k", "t", "id", [F.col("kind") == "view"])
    rows = df.filter("kind = 'view' and k is not null and t is not null")
    counts = {row["k"]: row["count"] for row in rows.groupBy("k").count().collect()}
    assert {row["k"]: row["n_complete"] for row in found.collect()} == counts


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rolling_distinct(empty, "k", "t", 7).count() == 0
    assert funnel(empty, "k", "t", "id", [F.col("kind") == "view"]).count() == 0
    with pytest.raises(ValueError, match="one day"):
        rolling_distinct(empty, "k", "t", 0)
