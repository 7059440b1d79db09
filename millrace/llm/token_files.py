"""Token ids in compressed binary files, written and read in parallel.

Writing:

* Texts are encoded where they are and the ids stored once. Pieces that no token reaches
  over are encoded apart and remembered: a worker keeps the ids of those it met last, in
  at most about ``WORDS_KEPT`` entries of short words.
* The ids' counts over all texts, one row per id of the vocabulary, make the frequency
  table that all files share (``rans.Table``), stored beside them.
* Documents are range-partitioned and sorted by id. Each range is one file: blocks of
  ``BLOCK_IDS`` ids, coded each by itself in interleaved lanes (``rans``), then the
  *checkpoints*, an entry per block with its place, its number of ids, the ids before it
  and a checksum. A block also names the documents that start in it, with their lengths.
* Files get their names only after the tasks that wrote them have reported; the manifest,
  a row per file, comes last, with how many ids are in all files before. An archive without
  one is not complete, and what lost attempts left behind is never read.

Reading: a task takes some blocks of a file by the checkpoints, follows its last document
into the blocks after them, and fails with ``Damaged`` if a checksum does not hold.

Each document's ids end with ``end_id``. Defined results: a null text is an empty one; a
null id sorts before all others; rows of one id are in the order of a hash of their ids,
and equal rows cannot be told apart; an empty table gives an archive without files. Only
the named columns are read, whatever other columns there are. Text with bytes that are no
UTF-8 is read with U+FFFD in their place. The strings of special tokens are ordinary text.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.arrays import LOWER, SPACED, Chunk, Words, chunks, gathered, words
from millrace.llm.frames import small_batches, stored
from millrace.llm.rans import LANES, Damaged, Table
from millrace.sources.shared import new_run_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_IDS = 64_000_000  # ids of one file, about
LEAST_SHARD_IDS = 250_000  # smaller files are not worth a task
BLOCK_IDS = 16_384
TOGETHER = 64  # blocks that are coded side by side
WORDS_KEPT = 400_000
LONGEST_KEPT = 32  # bytes of a piece that is remembered
CHUNK = 2_000_000  # bytes of text whose pieces are looked up at a time

_MAGIC = b"MILLRANS"
_CHECKPOINT = np.dtype(
    [("place", "<u8"), ("size", "<u4"), ("n_ids", "<u4"), ("before", "<u8"), ("crc", "<u4")]
)
_TRAILER = struct.Struct("<QII")  # the checkpoints' place, number and checksum
_MANIFEST = "file string, temporary string, shard int, n_docs bigint, n_ids bigint, blocks int, bytes bigint"
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[ord("a") : ord("z") + 1] = True
_IS_SIGN = SPACED & ~_IS_LETTER
_IS_SIGN[0x80:] = False


class WordEncoder(dict):
    """Ids by piece of text, for a tokenizer whose tokens reach neither over white space
    nor over the places that ``_cuts`` finds. Pieces are encoded when first asked for;
    those asked for last are remembered, in two generations.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelt = {ord(c): cut(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "÷"}
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            text = piece.decode()
            if _PLAIN.fullmatch(text):
                # One run of letters, which normalising leaves as it is.
                found = [token.id for token in self.model.tokenize(text.translate(self.spelt))]
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = array("H" if self.kind.itemsize == 2 else "I", found).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids

    def encode(self, chunk: Chunk) -> list[np.ndarray]:
        """The ids of each text of a chunk in UTF-8, as numbers of ``kind``."""
        data = LOWER[chunk.data]
        found = _pieces(data, chunk)
        sizes = found.ends - found.starts
        coded = gathered(data, found.starts, found.ends).dictionary_encode()
        made = [self[piece] for piece in coded.dictionary.to_pylist()]
        if len(self) > WORDS_KEPT // 2:
            self.older = dict(self)
            self.clear()
        ids = np.frombuffer(b"".join(made), self.kind)
        lengths = np.fromiter(map(len, made), np.int64, len(made)) // self.kind.itemsize
        code = coded.indices.to_numpy(zero_copy_only=False)
        sizes, starts = lengths[code], (np.cumsum(lengths) - lengths)[code]
        ends = np.cumsum(sizes)
        ids = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]
        bounds = np.append(0, ends)
        return [ids[i:j] for i, j in zip(bounds[found.first], bounds[found.last])]


def _pieces(data: np.ndarray, chunk: Chunk) -> Words:
    """Words between white space, cut further by ``_cuts``."""
    found = words(Chunk(chunk.first, data, chunk.starts, chunk.ends), SPACED)
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[found.starts] = True
    inside[1:-1] |= _cuts(data)
    starts = np.flatnonzero(inside)
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[found.ends] = True
    ends[1:-1] |= _cuts(data)
    ends = np.flatnonzero(ends)
    return Words(
        starts,
        ends,
        np.searchsorted(starts, chunk.starts, "left"),
        np.searchsorted(starts, chunk.ends, "left"),
    )


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether a token must end between each byte and the next, both inside a word: after
    a Latin letter before an ASCII sign or digit, and after such a sign or digit, save an
    apostrophe, before a Latin letter. Letters beyond Latin-1 are left alone."""
    ascii_ = _IS_LETTER[data]
    sign = _IS_SIGN[data]
    accented = np.zeros(len(data) + 1, dtype=bool)  # a letter of two bytes starts here
    accented[:-2] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    ended = ascii_[:-1].copy()
    ended[1:] |= accented[:-3] if len(data) > 1 else False
    begun = ascii_[1:] | accented[1:-1]
    return (ended & sign[1:]) | (sign[:-1] & (data[:-1] != ord("'")) & begun)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """Kept by a Python worker from one task to the next."""
    return WordEncoder(path)


def tokenized(
    docs: DataFrame, id_column: str, text_column: str, path: str, end_id: int = END_ID
) -> DataFrame:
    """``id, ids``: the ids of each text and the end id, as little-endian numbers."""
    rows = small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.make_valid_utf8(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
        .cast("binary")
        .alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for chunk in chunks(batch.column("text"), CHUNK):
                ids = [found.tobytes() + end for found in encoder.encode(chunk)]
                docs = batch.column("id").slice(chunk.first, len(ids))
                yield pa.RecordBatch.from_arrays([docs, pa.array(ids, pa.binary())], ["id", "ids"])

    return rows.mapInArrow(run, "id bigint, ids binary")


def write_tokens(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    folder: str,
    path: str | None = None,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write the ids of ``docs`` under ``folder``, a URI all executors can write to; the
    manifest."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(TOKENIZER)
    kind = _encoder(path).kind
    tokens = stored(tokenized(docs, id_column, text_column, path, end_id), "tokens")
    counts = _counts(tokens, kind)
    table, total = Table.of_counts(counts), sum(counts.values())
    _write_table(table, folder)
    shards = max(
        -(-total // shard_ids),
        min(-(-total // LEAST_SHARD_IDS), 2 * spark.sparkContext.defaultParallelism),
        1,
    )
    # Rows of one id are spread by what they hold, equal ones by where they are stored, so
    # that no id, however many rows it has, is one task's work.
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("place")]
    sorted_rows = (
        tokens.select("id", "ids", F.xxhash64("ids").alias("hash"), place.alias("place"))
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("id", "ids", F.spark_partition_id().alias("shard"))
    )
    shared = spark.sparkContext.broadcast(table.to_bytes())
    reported = stored(
        sorted_rows.mapInArrow(
            lambda batches: _write_shard(batches, folder, shared.value, kind, block_ids),
            _MANIFEST,
        ),
        "token-files",
    )
    named = reported.mapInArrow(lambda batches: _rename(batches, folder), _MANIFEST)
    manifest = f"{folder}/manifest"
    starts = _starts(reported)
    named.drop("temporary").join(starts, "shard").write.parquet(manifest)
    return spark.read.parquet(manifest)


def _counts(tokens: DataFrame, kind: str) -> dict[int, int]:
    """How often each id occurs: at most a row per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, dtype=np.int64)
        for batch in batches:
            column = batch.column("ids")
            ids = np.frombuffer(b"".join(column.to_pylist()), kind)
            found = np.bincount(ids, minlength=len(sums))
            found[: len(sums)] += sums
            sums = found
        ids = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums[ids])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id bigint, n bigint")
    return {row["id"]: row["n"] for row in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _starts(files: DataFrame) -> DataFrame:
    """For each file the ids of all files before it: one number per file, no more than
    Spark keeps of the tasks that wrote them."""
    rows, before = [], 0
    for shard, n_ids in sorted(tuple(x) for x in files.select("shard", "n_ids").collect()):
        rows.append((shard, before))
        before += n_ids
    return files.sparkSession.createDataFrame(rows, "shard int, start bigint")


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def _write_table(table: Table, folder: str) -> None:
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    temporary = f"{path}/_temporary-{uuid.uuid4().hex}-table"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(table.to_bytes())
    fs.move(temporary, f"{path}/table")


@dataclass
class _Docs:
    """Documents that start in a block: their places in it, ids and lengths."""

    starts: np.ndarray
    ids: np.ndarray
    known: np.ndarray  # whether the id is not null
    sizes: np.ndarray

    def pack(self) -> bytes:
        columns = (self.starts, self.ids, self.known, self.sizes)
        kinds = ("<u4", "<i8", "u1", "<u8")
        packed = b"".join(x.astype(kind).tobytes() for x, kind in zip(columns, kinds))
        return zlib.compress(packed, 1)

    @classmethod
    def unpack(cls, content: bytes) -> "_Docs":
        raw = zlib.decompress(content)
        n = len(raw) // 21
        return cls(
            np.frombuffer(raw, "<u4", n, 0).astype(np.int64),
            np.frombuffer(raw, "<i8", n, 4 * n),
            np.frombuffer(raw, "u1", n, 12 * n).astype(bool),
            np.frombuffer(raw, "<u8", n, 13 * n).astype(np.int64),
        )


class _Writer:
    """One file, in blocks."""

    def __init__(self, folder: str, shard: int, table: Table, block_ids: int):
        self.fs, self.path = _filesystem(folder)
        self.table, self.block_ids, self.shard = table, block_ids, shard
        self.name = f"part-{shard:06d}.rans"
        self.temporary = f"_temporary-{uuid.uuid4().hex}-{self.name}"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        self.checkpoints: list[tuple] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_docs = self.size = 0
        self.docs: list[tuple[int, int, bool, int]] = []  # place in the file, id, known, size
        self._put(_MAGIC + struct.pack("<II", block_ids, LANES) + table.digest)

    def _put(self, content: bytes) -> None:
        self.out.write(content)
        self.size += len(content)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        place = self.n_ids + self.n_waiting
        self.docs.append((place, doc or 0, doc is not None, len(ids)))
        self.n_docs += 1
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids * TOGETHER:
            self._send(self.n_waiting // self.block_ids * self.block_ids)

    def _send(self, n: int) -> None:
        """Write so many of the waiting ids."""
        joined = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        self.waiting = [joined[n:].copy()]
        self.n_waiting = len(joined) - n
        blocks = [joined[i : i + self.block_ids] for i in range(0, n, self.block_ids)]
        places = np.array([doc[0] for doc in self.docs], np.int64)
        for first in range(0, len(blocks), TOGETHER):
            part = blocks[first : first + TOGETHER]
            for block, (states, words) in zip(part, self.table.encode(part)):
                low, high = np.searchsorted(places, [self.n_ids, self.n_ids + len(block)])
                inside = self.docs[low:high]
                columns = list(zip(*inside)) or [(), (), (), ()]
                docs = _Docs(
                    np.array(columns[0], np.int64) - self.n_ids,
                    np.array(columns[1], np.int64),
                    np.array(columns[2], bool),
                    np.array(columns[3], np.int64),
                ).pack()
                content = (
                    struct.pack("<II", len(words), len(docs))
                    + states.astype("<u8").tobytes()
                    + words.astype("<u4").tobytes()
                    + docs
                )
                self.checkpoints.append(
                    (self.size, len(content), len(block), self.n_ids, zlib.crc32(content))
                )
                self._put(content)
                self.n_ids += len(block)
        self.docs = self.docs[int(np.searchsorted(places, self.n_ids)) :]

    def close(self) -> dict:
        self._send(self.n_waiting)
        index = np.array(self.checkpoints, _CHECKPOINT).tobytes()
        trailer = _TRAILER.pack(self.size, len(self.checkpoints), zlib.crc32(index))
        self._put(index + trailer + _MAGIC)
        self.out.close()
        return {
            "file": self.name,
            "temporary": self.temporary,
            "shard": self.shard,
            "n_docs": self.n_docs,
            "n_ids": self.n_ids,
            "blocks": len(self.checkpoints),
            "bytes": self.size,
        }


def _manifest_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = [field.split()[0] for field in _MANIFEST.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(names, kinds))))


def _write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, table: bytes, kind: str, block_ids: int
) -> Iterator[pa.RecordBatch]:
    writer = None
    for batch in batches:
        docs, shards = batch.column("id").to_pylist(), batch.column("shard")
        column = batch.column("ids")
        for i, doc in enumerate(docs):
            if writer is None:
                known = Table.from_bytes(table)
                writer = _Writer(folder, shards[i].as_py(), known, block_ids)
            writer.add(doc, np.frombuffer(column[i].as_py(), kind).astype(np.uint32))
    if writer is not None:
        yield _manifest_batch([writer.close()])


def _rename(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Give reported files their names. May be run again."""
    fs, path = _filesystem(folder)
    for batch in batches:
        for row in batch.to_pylist():
            target = f"{path}/{row['file']}"
            if fs.get_file_info(target).type == pafs.FileType.NotFound:
                fs.move(f"{path}/{row['temporary']}", target)
        yield batch


def read_tokens(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document ``id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` is the number of ids before the document's, over all files; the checksum is
    that of its ids as little-endian unsigned 32-bit integers.
    """
    spark: SparkSession = manifest.sparkSession
    fields = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    fields += ", ids array<bigint>" if with_ids else ""
    parts = manifest.select(
        "file", "start", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1, F.lit(TOGETHER))).alias("first")
    )
    blocks = manifest.agg(F.sum("blocks")).first()[0] or 0
    groups = -(-blocks // TOGETHER)
    # A few dozen groups, some megabytes each, to a task once there are more than enough.
    tasks = max(1, min(groups, max(4 * spark.sparkContext.defaultParallelism, groups // 32)))
    return small_batches(parts.repartition(tasks)).mapInArrow(
        lambda batches: _read_parts(batches, folder, with_ids), fields
    )


class _Reader:
    """One file, by its checkpoints."""

    def __init__(self, fs: pafs.FileSystem, path: str, table: Table):
        self.source, self.table, self.path = fs.open_input_file(path), table, path
        size = self.source.size()
        end = _TRAILER.size + len(_MAGIC)
        head = self._at(0, len(_MAGIC) + 40)
        tail = self._at(max(size - end, 0), end)
        if head[:8] != _MAGIC or tail[_TRAILER.size :] != _MAGIC or head[16:48] != table.digest:
            raise Damaged(f"{path} is not a whole file of this table")
        place, blocks, crc = _TRAILER.unpack(tail[: _TRAILER.size])
        index = self._at(place, blocks * _CHECKPOINT.itemsize)
        if zlib.crc32(index) != crc:
            raise Damaged(f"{path}: the checkpoints are damaged")
        self.checkpoints = np.frombuffer(index, _CHECKPOINT)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def blocks(self, first: int, last: int) -> list[tuple[int, np.ndarray, _Docs]]:
        """For each block: the ids before it, its ids, its documents."""
        coded, sizes, docs = [], [], []
        for entry in self.checkpoints[first:last]:
            content = self._at(int(entry["place"]), int(entry["size"]))
            if zlib.crc32(content) != entry["crc"]:
                raise Damaged(f"{self.path}: a block is damaged")
            n_words, n_docs = struct.unpack_from("<II", content)
            states = np.frombuffer(content, "<u8", LANES, 8)
            at = 8 + 8 * LANES
            words = np.frombuffer(content, "<u4", n_words, at)
            coded.append((states, words))
            sizes.append(int(entry["n_ids"]))
            docs.append(_Docs.unpack(content[at + 4 * n_words : at + 4 * n_words + n_docs]))
        ids = self.table.decode(coded, sizes)
        before = self.checkpoints["before"][first:last].astype(np.int64)
        return list(zip(before.tolist(), ids, docs))


def _read_parts(
    batches: Iterator[pa.RecordBatch], folder: str, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    fs, path = _filesystem(folder)
    table = None
    for batch in batches:
        for part in batch.to_pylist():
            if table is None:
                with fs.open_input_stream(f"{path}/table", compression=None) as source:
                    table = Table.from_bytes(source.read())
            reader = _Reader(fs, f"{path}/{part['file']}", table)
            for docs in _read_docs(reader, part["first"], with_ids):
                docs["start"] = docs["start"] + part["start"]
                yield _docs_batch(docs, with_ids)
            reader.source.close()


def _read_docs(reader: _Reader, first: int, with_ids: bool) -> Iterator[dict]:
    """The documents that start in ``TOGETHER`` blocks from ``first`` on."""
    found = reader.blocks(first, first + TOGETHER)
    base = found[0][0]
    ids = np.concatenate([block for _, block, _ in found]).astype("<u4")
    starts = np.concatenate([before - base + docs.starts for before, _, docs in found])
    sizes = np.concatenate([docs.sizes for _, _, docs in found])
    docs = np.concatenate([docs.ids for _, _, docs in found])
    known = np.concatenate([docs.known for _, _, docs in found])
    if not len(starts):
        return
    pieces = [ids[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())]
    crcs = [zlib.crc32(piece) for piece in pieces]
    # Only the last one may go on; its ids are read a few blocks at a time.
    missing, at = int(starts[-1] + sizes[-1]) - len(ids), first + TOGETHER
    rest = [pieces[-1]]
    while missing > 0:
        wanted = min(TOGETHER, -(-missing // len(found[0][1])))
        more = [block for _, block, _ in reader.blocks(at, at + wanted)]
        if not more:
            raise Damaged(f"{reader.path} ends within a document")
        piece = np.concatenate(more)[:missing].astype("<u4")
        crcs[-1] = zlib.crc32(piece, crcs[-1])
        missing, at = missing - len(piece), at + wanted
        if with_ids:
            rest.append(piece)
    made = {
        "id": pa.array(docs, pa.int64(), mask=~known),
        "start": starts + base,
        "n_tokens": sizes,
        "ids_crc32": np.array(crcs, dtype=np.int64),
    }
    if with_ids:
        pieces[-1] = np.concatenate(rest)
        made["ids"] = pa.array([p.astype(np.int64) for p in pieces], pa.list_(pa.int64()))
    yield made


def _docs_batch(docs: dict, with_ids: bool) -> pa.RecordBatch:
    names = ["id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    columns = [c if isinstance(c := docs[name], pa.Array) else pa.array(c) for name in names]
    return pa.RecordBatch.from_arrays(columns, names=names)


def token_folder(spark: SparkSession) -> str:
    """A new folder for an archive under the shared one."""
    return new_run_dir(spark, "tokens")
