"""Aggregations that shrink the rows on the map side before anything is expanded."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import time_bucket, whole


def count_cube(df: DataFrame, keys: list[str], count: str = "n_rows") -> DataFrame:
    """Row counts for every subset of ``keys``, with ``<key>_total`` 1 where the
    key is summed over.

    A cube copies each of its input rows once per subset, so it is taken over the
    counts per full key instead of over the rows.
    """
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = [whole(F.grouping(key)).alias(f"{key}_total") for key in keys]
    return base.cube(*keys).agg(*totals, whole(F.sum("_n")).alias(count))


def sliding_counts(df: DataFrame, ts: str, width: str, slide: str) -> DataFrame:
    """Rows per window of ``width`` opening every ``slide``: ``window_start, n_rows``.

    Rows are counted per ``slide`` first and the windows are summed from those
    counts, so rows are not copied into every window they fall in. ``width`` must
    be a multiple of ``slide``.
    """
    if pd.Timedelta(width) % pd.Timedelta(slide):
        raise ValueError(f"{width} is not a multiple of {slide}")
    panes = df.groupBy(time_bucket(ts, slide).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return (
        panes.groupBy(F.window("_pane", width, slide).alias("_window"))
        .agg(whole(F.sum("_n")).alias("n_rows"))
        .select(F.col("_window.start").alias("window_start"), "n_rows")
    )


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "n_rows") -> DataFrame:
    """Key values that occur more than once, with how often."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count))
        .filter(F.col(count) > 1)
    )


def latest_per_key(
    df: DataFrame, key: str, order: list[str], carry: list[str]
) -> DataFrame:
    """The row of each ``key`` that is last by ``order``: ``key, *order, *carry``.

    Each map task keeps one row per key, so a key with most of the rows costs one
    row per task in the shuffle.
    """
    newest = df.groupBy(key).agg(F.max(F.struct(*order, *carry)).alias("_row"))
    return newest.select(key, "_row.*")


def count_matrix(
    df: DataFrame, row: str, column: str, names: dict[str, str], other: str
) -> DataFrame:
    """Row counts per ``row``, one output column per value of ``column``, and ``other``
    for rows with any other value or null, so that the counts add up to the rows.

    ``names`` maps each value to its output column. With the values given, this is
    one aggregation; ``pivot`` would add a second one and its shuffle.
    """
    return df.groupBy(row).agg(
        *(F.count_if(F.col(column) == value).alias(name) for value, name in names.items()),
        F.count_if(~F.coalesce(F.col(column).isin(*names), F.lit(False))).alias(other),
    )


def total_per_key(df: DataFrame, key: str, value: Column, total: str) -> DataFrame:
    """Sum of ``value`` per ``key``."""
    return df.groupBy(key).agg(F.sum(value).alias(total))
