"""Batch and streaming readers for the Parquet tables of one scale folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# The tables' schemas. Stating them spares a job per table that reads a footer only
# to find the types, and fixes the types whatever the session's settings.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as it is stored."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# A micro-batch of files by their size, see ``table_stream``.
BY_SIZE = "size"
# Bytes of a micro-batch for each core, about one scan task's. State is evicted between
# batches, so it is bounded by a batch, not by the backlog.
BYTES_PER_CORE = 128 << 20


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | str | None = None
) -> DataFrame:
    """One table as a file stream.

    A micro-batch is ``files_per_batch`` files, or with ``BY_SIZE`` as many as give every
    core ``BYTES_PER_CORE``, however small or large they are; then the files should follow
    each other in time. With None the whole backlog is the first micro-batch, so no row of
    it can be late whatever order the files are listed in.
    """
    reader = spark.readStream.schema(SCHEMAS[name])
    if files_per_batch == BY_SIZE:
        size = BYTES_PER_CORE * spark.sparkContext.defaultParallelism
        reader = reader.option("maxBytesPerTrigger", size)
    elif files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The file source takes a plain path for a folder and fails when it is a
    # single file; a pattern (here with one match) is accepted for both.
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")
