"""Running a stream over what its source holds, into a Parquet table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.shared import new_run_dir

_REMEMBERED = "spark.sql.streaming.numRecentProgressUpdates"
_STATE = {
    # State is kept in local RocksDB files, not on the heap, and each batch uploads
    # its changes to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows in the store reads each key before writing it.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # All batches of a run are looked through for rows that came too late.
    _REMEMBERED: "100000",
    # Each task joins its rows into sessions before the shuffle, so a user with
    # most of the rows sends sessions, not rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


class LateRows(RuntimeError):
    """Rows came after the watermark had passed them and were left out, or there were too
    many batches to tell."""


def run_available(
    stream: DataFrame, path: str, checkpoint: str, allow_late: bool = False
) -> DataFrame:
    """Process all available input, append the results at ``path``, return that table.

    Raises ``LateRows`` if the watermark dropped rows, or if there were too many batches
    to tell, unless that is allowed.

    Calling it again with the same folders goes on where the last run stopped; each
    input row counts once even if tasks or whole runs fail in between. Both folders
    must be on storage that all executors share.
    """
    spark = stream.sparkSession
    with _session_conf(spark, _STATE):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
    query.awaitTermination()
    progress = query.recentProgress
    dropped = rows_dropped(progress)
    if len(progress) >= int(_STATE[_REMEMBERED]) and not allow_late:
        raise LateRows(
            "more batches than can be looked through for rows that came too late: take "
            "larger ones, or allow late rows"
        )
    if dropped and not allow_late:
        raise LateRows(
            f"{dropped} rows came too late: take the files in time order, more of them "
            "per batch, or allow late rows"
        )
    return spark.read.schema(stream.schema).parquet(path)


def run_once(stream: DataFrame, name: str) -> DataFrame:
    """``run_available`` into new folders under the shared folder."""
    folder = new_run_dir(stream.sparkSession, name)
    return run_available(stream, f"{folder}/table", f"{folder}/checkpoint")


def rows_dropped(progress: list) -> int:
    """Rows that the watermark has kept from any stateful step, over all batches."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for batch in progress
        for operator in batch["stateOperators"]
    )


@contextmanager
def _session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the queries started inside; a query copies the session's."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
