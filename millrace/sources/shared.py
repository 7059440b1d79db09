"""The folder that all executors share: checkpoints, stream state, written tables."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RUNS = "millrace"
_RUN_NAME = re.compile(r".+-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary folder; on a
    cluster that is an error, since executors would not share the folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    in_use = context.getCheckpointDir()
    if in_use is not None:
        return in_use.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)
    return folder


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder for one run of a job."""
    return f"{shared_dir(spark)}/{_RUNS}/{name}-{uuid.uuid4()}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, so losing an executor
    costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(
    df: DataFrame, max_rows: int = 100_000, max_bytes: int = 16_000_000
) -> DataFrame | None:
    """``df`` marked for broadcast, or None when it has more than ``max_rows`` rows or
    ``max_bytes`` bytes.

    One job counts at most ``max_rows + 1`` rows and their bytes. Hand in stored data
    (``checkpointed``), otherwise the count computes it.
    """
    width = sum((_width(field) for field in df.schema.fields), F.lit(0))
    rows, size = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)))
        .first()
    )
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else None


def _width(field: T.StructField) -> Column:
    """About how many bytes a value takes."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 16 + F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(column))
        return 16 + 2 * F.coalesce(F.octet_length(text), F.lit(0))
    return F.lit(16)


def remove_old_runs(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Delete the folders that ``new_run_dir`` has named and that have not changed for
    that long; returns them. Nothing else in the shared folder is touched.

    Runs leave tables behind that their callers may still read, so this is for the
    operator to call, with an age that no running job reaches.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{shared_dir(spark)}/{_RUNS}")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    latest = (time.time() - older_than_hours * 3600) * 1000
    removed = []
    for status in files.listStatus(root):
        path = status.getPath()
        is_run = status.isDirectory() and _RUN_NAME.fullmatch(path.getName())
        if is_run and _changed(files, status) <= latest:
            files.delete(path, True)
            removed.append(path.getName())
    return sorted(removed)


def _changed(files, status) -> int:
    """When a folder or what is in it was last changed, in milliseconds."""
    changed = status.getModificationTime()
    if status.isDirectory():
        changed = max([changed, *(_changed(files, x) for x in files.listStatus(status.getPath()))])
    return changed
