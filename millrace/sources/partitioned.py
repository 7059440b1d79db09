"""Parquet tables laid out in one folder per value of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitioned(df: DataFrame, path: str, by: str) -> DataFrame:
    """Write ``df`` under ``path``, one folder per value of ``by``; the table written.

    The rebalance hint gathers the rows of a value so that a folder does not get
    one file per task, and adaptive execution splits a value that is too large
    for one task, so a value with most of the rows is still written in parallel.
    """
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
