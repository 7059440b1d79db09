"""Steps taken in a given order, by transitions that can be combined piece by piece.

Someone who has taken ``n`` of ``k`` steps waits for step ``n % k``; any other row leaves
them where they are. What a run of rows does to them is therefore known from how many
steps they take in it for each of the ``k`` steps they may be waiting for, and two runs
one after the other are put together from those counts alone. Runs of a key can so be
summed up apart from each other, whoever has most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import time_bucket

PIECES = ("1 minute", "1 day")


def _one_after_the_other(runs: Column, k: int) -> Column:
    """The transition of an array of ``taken`` transitions in order of time."""
    nothing = F.array_repeat(F.lit(0).cast("bigint"), k)

    def add(taken: Column, run: Column) -> Column:
        # From step ``s`` on, ``n`` have been taken by now, so ``s + n`` is waited for.
        return F.transform(taken, lambda n, s: n + F.get(run["taken"], ((s + n) % k).cast("int")))

    return F.aggregate(runs, nothing, add)


def funnel(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    steps: list[Column],
    pieces: tuple[str, ...] = PIECES,
) -> DataFrame:
    """``key, n_steps, n_complete`` for the keys that have a row with a time in one of
    ``steps``: how far they came at best (0 to the number of steps) and how often they
    took all of them. Rows go by ``ts``, ``tie`` and step; a row is the first of the steps
    it meets; after the last step the first one is waited for. Rows without a key are
    left out.

    A key's rows are put together within each of ``pieces``, then those within the next,
    and at last the largest. Only rows of one key in the first of them meet as rows; what
    goes on are ``k`` numbers each.
    """
    k = len(steps)
    step = F.coalesce(*(F.when(met, F.lit(i)) for i, met in enumerate(steps)))
    rows = df.select(key, ts, tie, step.alias("_step")).filter(
        F.col("_step").isNotNull() & F.col(key).isNotNull() & F.col(ts).isNotNull()
    )
    taken = F.array(*((F.col("_step") == i).cast("bigint") for i in range(k)))
    # The place of a run, then its transition: sorting goes by place.
    runs = rows.select(
        key, F.col(ts).alias("_at"), F.struct(ts, tie, "_step", taken.alias("taken")).alias("_run")
    )
    for length in (*pieces, None):
        by = [key] if length is None else [key, time_bucket("_at", length).alias("_at")]
        done = runs.groupBy(*by).agg(F.sort_array(F.collect_list("_run")).alias("_runs"))
        whole = _one_after_the_other(F.col("_runs"), k)
        if length is None:
            runs = done.select(key, whole.alias("_taken"))
        else:
            runs = done.select(
                key, "_at", F.struct(F.col("_at").alias("at"), whole.alias("taken")).alias("_run")
            )
    n = F.get("_taken", F.lit(0))
    return runs.select(
        key,
        F.least(n, F.lit(k).cast("bigint")).alias("n_steps"),
        F.call_function("div", n, F.lit(k).cast("bigint")).alias("n_complete"),
    )
