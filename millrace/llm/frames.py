"""DataFrame helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrays import mix
from millrace.sources.shared import new_run_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from
    the loss of executors, and read with column pruning."""
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` has written and nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    folders = {file.rpartition("/")[0] for file in df.inputFiles()}
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(df: DataFrame) -> DataFrame:
    """Lets Spark hand rows to Python in batches of a few megabytes, since texts may be
    long and several tasks share an executor's memory.

    In a local session it also tells Python workers where this package is, wherever the
    session was started; on a cluster the package is sent along with the job.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    if spark.sparkContext.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return df


def release_memory() -> None:
    """Give back what earlier tasks of this Python worker have freed and its allocator
    still holds; Spark keeps workers from stage to stage."""
    gc.collect()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def add_columns(
    df: DataFrame,
    fields: str,
    make: Callable[[pa.RecordBatch], dict[str, pa.Array]],
) -> DataFrame:
    """``df`` with the columns of ``fields``, made batch by batch where the rows are.

    Columns of ``df`` that have the name of a new one, in capitals or not, are replaced,
    but ``make`` sees them.
    """
    small_batches(df)
    new = T.StructType.fromDDL(fields)
    replaced = {name.lower() for name in new.fieldNames()}
    kept = [f for f in df.schema.fields if f.name.lower() not in replaced]
    schema = T.StructType([*kept, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [made[n] for n in new.names],
                names=schema.names,
            )

    return df.mapInArrow(run, schema)


FILTER_BITS = 1 << 25
_SEGMENT = 1 << 15


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """One bit for each of ``FILTER_BITS`` hash values of a bigint column, 4 MB whatever
    the number of keys: rows whose bit is not set need not be moved to a join with them.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            places = np.unique(_places(batch.column(column)))
            for segment in np.unique(places // _SEGMENT):
                bits = parts.setdefault(int(segment), np.zeros(_SEGMENT, dtype=bool))
                bits[places[places // _SEGMENT == segment] % _SEGMENT] = True
        yield _bit_batch({k: zlib.compress(np.packbits(v), 1) for k, v in parts.items()})

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bits = np.frombuffer(zlib.decompress(row["bits"]), dtype=np.uint8)
                parts[row["segment"]] = parts.get(row["segment"], 0) | bits
        yield _bit_batch({k: v.tobytes() for k, v in parts.items()})

    fields = "segment int, bits binary"
    rows = keys.select(column).mapInArrow(mark, fields).repartition(16, "segment")
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in rows.mapInArrow(unite, fields).collect():
        start = row["segment"] * (_SEGMENT // 8)
        bits[start : start + _SEGMENT // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def may_match(bits: np.ndarray, values: pa.Array) -> np.ndarray:
    """Which values may be among the keys; for all others it is certain."""
    places = _places(values)
    return (bits[places // 8] >> (7 - places % 8)) & 1 == 1


def _places(values: pa.Array) -> np.ndarray:
    numbers = values.to_numpy(zero_copy_only=False).view(np.uint64)
    return (mix(numbers) % np.uint64(FILTER_BITS)).astype(np.int64)


def _bit_batch(parts: dict[int, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "segment": pa.array(list(parts), pa.int32()),
            "bits": pa.array(list(parts.values()), pa.binary()),
        }
    )


def texts_of(column: pa.Array) -> list[str | None]:
    """A string column's values; bytes that are no UTF-8 are read as U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        raw = column.cast(pa.binary()).to_pylist()
        return [None if text is None else text.decode("utf-8", "replace") for text in raw]


_MILLION, _PLACES = 10**6, 10**18


def place_of(id_: Column, seed: int) -> Column:
    """Where a row stands in an order by hash: a number below 10^18."""
    high = F.pmod(F.xxhash64(id_, F.lit(seed)), F.lit(_MILLION))
    low = F.pmod(F.xxhash64(id_, F.lit(seed), F.lit(1)), F.lit(_PLACES // _MILLION))
    return high * F.lit(_PLACES // _MILLION) + low


def share_of(sample: int, n: int) -> int:
    """Below which place about ``sample`` of ``n`` rows stand, however many ``n`` are."""
    return min(sample * _PLACES // max(n, 1), _PLACES)


def same(a: Column, b: Column) -> Column:
    """Equality in which nulls are equal."""
    return a.eqNullSafe(b)


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
