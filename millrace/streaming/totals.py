"""Totals of a stream of additions and removals, kept so that a batch counts once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import split_sum, split_sum_again, split_total
from millrace.sources.shared import new_run_dir


def run_totals(
    changes: DataFrame, keys: list[str], sign: str, units: Column, path: str, checkpoint: str
) -> DataFrame:
    """Process all available ``changes`` and return ``keys, n_rows, total``: the rows that
    were added and not removed, and the sum of their whole ``units`` as hundredths. Keys of
    which no row is left are not there.

    ``sign`` is 1 for a row that is added and -1 for one that is removed; a removal may come
    in any batch, also before its addition. Each batch is summed up per key and replaces what
    is stored at ``path`` under its number. A batch that runs again after a failure, also one
    between writing and committing, has the same number and the same rows, so it counts once.
    The stored rows are one per key and batch. Calling it again with the same folders goes
    on where the last run stopped. Both folders must be on storage that all executors share.
    """
    spark = changes.sparkSession
    change = changes.select(
        *keys, F.col(sign).cast("bigint").alias("_sign"), (units * F.col(sign)).alias("_units")
    )

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("_sign").alias("n_rows"), *split_sum(F.col("_units"), "total")
        )

    empty = sums(spark.createDataFrame([], change.schema))
    # So that there is a table to read even if there never is a batch.
    _store(empty, f"{path}/batch=-1")
    query = (
        change.writeStream.foreachBatch(
            lambda rows, number: _store(sums(rows), f"{path}/batch={number}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return totals(spark.read.schema(empty.schema).parquet(path), keys)


def totals(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The sum over the stored batches."""
    added = stored.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), *split_sum_again("total")
    )
    return added.filter("n_rows <> 0").select(*keys, "n_rows", split_total("total", 2).alias("total"))


def totals_once(
    changes: DataFrame, keys: list[str], sign: str, units: Column, name: str
) -> DataFrame:
    """``run_totals`` into new folders under the shared folder."""
    folder = new_run_dir(changes.sparkSession, name)
    return run_totals(changes, keys, sign, units, f"{folder}/table", f"{folder}/checkpoint")


def _store(sums: DataFrame, folder: str) -> None:
    sums.write.mode("overwrite").parquet(folder)
