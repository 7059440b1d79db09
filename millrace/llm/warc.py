"""WARC archives written in parallel, the same whatever the cluster looks like.

* Records are sorted by id, then by a hash of what they hold, over the whole archive.
  Sizes are added up in that order (by range, with the totals of the ranges before), and
  a shard ends wherever the sum passes another ``shard_bytes``. So shards are ranges,
  whatever the ids are and however many rows one id has, and follow from the rows alone,
  not from sampling or partitions. Only ids, hashes and sizes are moved for it; the
  driver holds where each shard begins, 16 bytes per shard.
* A shard is written by one task, record by record, as files of gzip members, closed
  once they reach ``file_bytes`` compressed; at most ``MAX_TASKS`` tasks write one or
  more consecutive shards each. Headers and digests are made anew from the payload.
* A task writes under temporary names that no other attempt uses and reports what it
  wrote. Only reported files are then renamed, and the manifest, a table with a row
  for each file, is written last: an archive without it is not complete. Files of
  attempts that were lost keep their temporary names and are never read.

Of equal payloads of at least ``min_revisit`` bytes the one with the largest id is a
*response*; the others are *revisits*, without payload, that refer to it. Smaller
payloads are all responses.

Defined results: a null payload is an empty one; a null id sorts before all others
and is the response only if no equal payload has an id; rows that repeat an id and a
payload are all of the same type, under record ids of their own; an empty table gives an
archive without files. Rows equal in id, URI and payload are one shard's, however many.
Control characters in a URI are written as %XX, all else as it is. Only the named columns
are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.frames import small_batches, stored
from millrace.sources.shared import new_run_dir

SHARD_BYTES = 64_000_000
FILE_BYTES = 32_000_000
MIN_REVISIT = 1000
MAX_TASKS = 20_000
# The media types and the profile that the format's standard names.
_RESPONSE_TYPE = "application/http; msgtype=response"
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "file string, temporary string, shard int, records bigint, bytes bigint, sha1 string"
_RECORD = (
    "id bigint, uri string, record_type string, payload_digest string, "
    "payload_bytes bigint, refers_to bigint, payload binary"
)


def record_types(
    pages: DataFrame, id_column: str, payload_column: str, min_revisit: int = MIN_REVISIT
) -> DataFrame:
    """The revisits: distinct ``id, digest, refers_to``.

    Payloads themselves are not moved, only digests, and of those only the ones that
    occur more than once, reduced to one row per digest and task first.
    """
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    known = pages.select(
        F.col(id_column).cast("bigint").alias("id"), payload.alias("payload")
    ).select("id", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    large = known.filter(F.col("size") >= min_revisit).select("id", "digest")
    repeated = (
        large.groupBy("digest")
        .agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .drop("n")
    )
    return (
        large.join(repeated, "digest")
        .filter(~F.col("id").eqNullSafe(F.col("refers_to")))
        .distinct()
    )


def write_archive(
    pages: DataFrame,
    id_column: str,
    uri_column: str,
    payload_column: str,
    folder: str,
    min_revisit: int = MIN_REVISIT,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write ``pages`` under ``folder``, a URI all executors can write to; the manifest."""
    rows = small_batches(pages).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.make_valid_utf8(F.col(uri_column).cast("string")).alias("uri"),
        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"),
    )
    begins = _begins(rows, shard_bytes)
    first, last, shard_of = _lookups(begins, pages.sparkSession)
    revisits = record_types(pages, id_column, payload_column, min_revisit)
    # A page's type travels to its shard as a row of its own that sorts before the
    # page, so that pages are moved only once.
    nothing = F.lit(None)
    records = rows.select(
        shard_of("id", _row_hash()).alias("shard"),
        "id",
        F.lit(1).alias("kind"),
        F.sha1("payload").alias("digest"),
        nothing.cast("bigint").alias("refers_to"),
        "uri",
        "payload",
    ).withColumn("nth", F.col("shard") - first("id"))
    # An id over several shards needs the type in all of them.
    types = revisits.select(
        F.explode(F.sequence(first("id"), last("id"))).alias("shard"),
        "id",
        F.lit(0).alias("kind"),
        "digest",
        "refers_to",
        nothing.cast("string").alias("uri"),
        nothing.cast("binary").alias("payload"),
        F.lit(0).alias("nth"),
    )
    per_task = -(-len(begins) // MAX_TASKS) or 1
    tasks = -(-len(begins) // per_task) or 1
    placed = (
        records.unionByName(types)
        .repartitionById(tasks, F.floor(F.col("shard") / per_task).cast("int"))
        .sortWithinPartitions("shard", "id", "digest", "kind", F.xxhash64("uri"))
    )
    reported = stored(
        placed.mapInArrow(
            lambda batches: _write_shard(batches, folder, file_bytes), _MANIFEST
        ),
        "warc-files",
    )
    committed = reported.mapInArrow(lambda batches: _rename(batches, folder), _MANIFEST)
    manifest = f"{folder}/manifest"
    committed.drop("temporary").write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def _row_hash() -> Column:
    return F.xxhash64("payload", "uri")


def _begins(rows: DataFrame, shard_bytes: int) -> list[tuple[int, int, int]]:
    """Where each shard begins: whether the id is known, the id, the row's hash."""
    spark = rows.sparkSession
    # 300 bytes stand for the headers.
    sizes = (
        rows.select("id", _row_hash().alias("hash"), (F.length("payload") + 300).alias("size"))
        .groupBy("id", "hash")
        .agg(F.sum("size").alias("size"))
    )
    order = [F.col("id").asc_nulls_first(), F.col("hash")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            size = batch.column("size").to_numpy(zero_copy_only=False)
            start = done + np.cumsum(size) - size
            done += int(size.sum())
            yield batch.append_column("start", pa.array(start))

    placed = stored(
        sizes.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"))
        .mapInArrow(run, "id bigint, hash bigint, size bigint, part int, start bigint"),
        "warc-places",
    )
    # One sum per partition, then one row per shard.
    offsets, done = [], 0
    for part, size in sorted(placed.groupBy("part").agg(F.sum("size")).collect()):
        offsets.append((part, done))
        done += size
    before = spark.createDataFrame(offsets, "part int, before bigint")
    found = (
        placed.join(before, "part")
        .select(
            F.expr(f"(start + before) div {shard_bytes}").alias("shard"),
            F.struct(F.col("id").isNotNull().cast("int").alias("known"), "id", "hash").alias("row"),
        )
        .groupBy("shard")
        .agg(F.min("row").alias("row"))
        .select("row.known", F.coalesce("row.id", F.lit(0)), "row.hash")
        .collect()
    )
    return sorted(tuple(row) for row in found)


def _lookups(begins: list[tuple[int, int, int]], spark: SparkSession):
    """Columns for the first and the last shard that may hold an id, and for the shard of
    a row by its id and hash."""
    nulls = sum(not known for known, _, _ in begins)
    ids = np.array([id_ for known, id_, _ in begins if known], dtype=np.int64)
    hashes = np.array([hash_ for _, _, hash_ in begins], dtype=np.int64)
    shared = spark.sparkContext.broadcast((nulls, ids, hashes))

    def spans(known: pd.Series, id_: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The shards that begin within each id."""
        nulls, ids, _ = shared.value
        known, id_ = known.to_numpy(), id_.to_numpy()
        low = np.where(known, nulls + np.searchsorted(ids, id_, "left"), 0)
        return low, np.where(known, nulls + np.searchsorted(ids, id_, "right"), nulls)

    def first_of(known: pd.Series, id_: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(spans(known, id_)[0] - 1, 0))

    def last_of(known: pd.Series, id_: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(spans(known, id_)[1] - 1, 0))

    def shard_of(known: pd.Series, id_: pd.Series, hash_: pd.Series) -> pd.Series:
        low, high = spans(known, id_)
        shard, own = low - 1, hash_.to_numpy()
        inside = np.flatnonzero(high > low)
        for start in np.unique(low[inside]):
            rows = inside[low[inside] == start]
            begun = shared.value[2][start : high[rows[0]]]
            shard[rows] += np.searchsorted(begun, own[rows], "right")
        return pd.Series(np.maximum(shard, 0))

    def column(function):
        made = F.pandas_udf(function, "int")
        return lambda id_, *others: made(
            F.col(id_).isNotNull(), F.coalesce(F.col(id_), F.lit(0).cast("bigint")), *others
        )

    return column(first_of), column(last_of), column(shard_of)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def _head(kind: str, fields: list[tuple[str, str]], size: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{name}: {value}" for name, value in fields]
    return "\r\n".join([*lines, f"Content-Length: {size}", "", ""]).encode()


def _one_line(text: str) -> str:
    """Without what would end or bend a header's line."""
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", text)


def _record_id(id_: int | None, digest: str, again: str = "") -> str:
    """The same for the same page, so that archives can be written anew."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{id_}/{digest}{again}')}>"


def record(
    id_: int | None, uri: str | None, payload: bytes, refers_to: int | None, again: str = ""
) -> bytes:
    """One WARC record of an HTTP response; a revisit if ``refers_to`` is given. ``again``
    tells apart the records of rows that repeat an id and a payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Record-ID", _record_id(id_, digest, again)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _one_line(uri or "")),
        ("X-Page-Id", "" if id_ is None else str(id_)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Type", _RESPONSE_TYPE),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", _REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    kind = "response" if refers_to is None else "revisit"
    return _head(kind, fields, len(block)) + block + b"\r\n\r\n"


class _Files:
    """Files of one shard, closed and counted as they reach their size."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.fs, self.path = _filesystem(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.shard, self.file_bytes, self.attempt = shard, file_bytes, uuid.uuid4().hex
        self.done: list[dict] = []
        self.out = None

    def add(self, content: bytes) -> None:
        if self.out is None:
            name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.name, self.temporary = name, f"_temporary-{self.attempt}-{name}"
            self.out = self.fs.open_output_stream(
                f"{self.path}/{self.temporary}", compression=None
            )
            self.size, self.records, self.sha1 = 0, 0, hashlib.sha1()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(content) + packer.flush()
        self.out.write(member)
        self.sha1.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append(
                {
                    "file": self.name,
                    "temporary": self.temporary,
                    "shard": self.shard,
                    "records": self.records,
                    "bytes": self.size,
                    "sha1": self.sha1.hexdigest(),
                }
            )


def _manifest_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = ["file", "temporary", "shard", "records", "bytes", "sha1"]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(names, kinds))))


def _write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int
) -> Iterator[pa.RecordBatch]:
    files, repeated = None, 0
    type_of, refers_to, before = None, None, None
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
            page = (row["id"], row["digest"])
            if row["kind"] == 0:
                type_of, refers_to = page, row["refers_to"]
                continue
            if files is None or files.shard != row["shard"]:
                if files is not None:
                    files.close()
                    yield _manifest_batch(files.done)
                files = _Files(folder, row["shard"], file_bytes)
                before = None
            repeated = repeated + 1 if page == before else 0
            before = page
            again = f"/{row['shard']}/{repeated}" if repeated or row["nth"] else ""
            target = refers_to if page == type_of else None
            files.add(record(row["id"], row["uri"], row["payload"], target, again))
    if files is not None:
        files.close()
        yield _manifest_batch(files.done)


def _rename(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Give reported files their names. May be run again: a file that has its name
    already is left alone."""
    fs, path = _filesystem(folder)
    for batch in batches:
        for row in batch.to_pylist():
            target = f"{path}/{row['file']}"
            if fs.get_file_info(target).type == pafs.FileType.NotFound:
                fs.move(f"{path}/{row['temporary']}", target)
        yield batch


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of an archive, one task per file; fails if a file or a digest is not
    what the manifest and the headers say. ``payload`` is null for revisits."""
    files = manifest.count()
    return (
        small_batches(manifest)
        .select("file", "sha1")
        .repartition(max(files, 1))
        .mapInArrow(lambda batches: _read_files(batches, folder), _RECORD)
    )


def _read_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, path = _filesystem(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_stream(f"{path}/{row['file']}", compression=None) as source:
                rows, size = [], 0
                for found in _records(source, row["sha1"], row["file"]):
                    rows.append(found)
                    size += len(found["payload"] or b"")
                    if size > 8_000_000 or len(rows) >= 1000:
                        yield _record_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _record_batch(rows)


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [
        pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()
    ]
    names = [field.split()[0] for field in _RECORD.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(names, kinds))))


def _members(source, sha1: str, name: str) -> Iterator[bytes]:
    """The unpacked gzip members of a file, read a piece at a time."""
    seen = hashlib.sha1()
    unpacker, out, rest = zlib.decompressobj(31), io.BytesIO(), b""
    while piece := rest or source.read(1 << 20):
        if not rest:
            seen.update(piece)
        out.write(unpacker.decompress(piece))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield out.getvalue()
            unpacker, out = zlib.decompressobj(31), io.BytesIO()
    if seen.hexdigest() != sha1 or out.tell():
        raise ValueError(f"{name} is not the file that the manifest names")


def _records(source, sha1: str, name: str) -> Iterator[dict]:
    for member in _members(source, sha1, name):
        yield parse_record(member)


def parse_record(content: bytes) -> dict:
    """One record; digests are checked against what is there."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(
        int(line.split(b":")[1])
        for line in http.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    response = fields["WARC-Type"] == "response"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = lambda text: int(text) if text else None
    return {
        "id": number(fields["X-Page-Id"].strip()),
        "uri": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": size,
        "refers_to": number(fields.get("X-Refers-To-Page-Id")),
        "payload": payload if response else None,
    }


def archive_folder(spark) -> str:
    """A new folder for an archive under the shared one."""
    return new_run_dir(spark, "warc")
