"""Repeats of a given length in a corpus, found through anchors.

1. Every text names its anchors, those with one core and context in one row. Cores are
   counted, one row per core and task, and only anchors with repeated cores go on.
2. Where all anchors of a core have one context, all their windows are repeats.
3. Where contexts differ, one text per distinct context lends its content, and a
   *resolver* (suffix runs or suffix automata) says for each context which of its
   windows occur in another.
4. Each text gets its marks: per anchor the windows that are repeats, as the least and
   the greatest distance of their starts before the anchor. All windows in between
   overlap both, so they cover the same codes.

Copies are counted, not compared: however many texts share a passage, each distinct
context is looked at once, and a passage that a text repeats crosses no join more than
once for that text. A core with more than ``GROUP_CONTEXTS`` distinct contexts
is not given to one task: its windows are compared one by one, as rows spread by
their own hash. Skewed joins on cores and contexts are split by adaptive execution.

Texts cross a shuffle packed by zlib, since they are most of what is moved.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import anchors
from millrace.llm.arrays import SPACED, Chunk, Hashes, Words, chunks, mix, words
from millrace.llm.frames import may_match, same, small_batches, stored

GROUP_CONTEXTS = 20_000
CONTENT = "g bigint, c bigint, v bigint, left int, right int, content binary"
_WINDOWS = "g bigint, c bigint, v bigint, distance int, w bigint"


@dataclass(frozen=True)
class Unit:
    """What windows are made of: bytes, or words between ASCII white space."""

    by_words: bool
    window: int
    core: int
    # Whether a repeat counts only in texts that come after another that has it.
    later_only: bool

    @property
    def reach(self) -> int:
        return self.window - self.core

    def split(self, chunk: Chunk) -> tuple[Hashes, np.ndarray, np.ndarray, Words | None]:
        """Hashes of the codes, and each text's range of codes."""
        if not self.by_words:
            return Hashes.of_bytes(chunk.data), chunk.starts, chunk.ends, None
        found = words(chunk, SPACED)
        codes = Hashes.of_bytes(chunk.data).runs(found.starts, found.ends)
        return Hashes(codes), found.first, found.last, found

    def content(self, chunk: Chunk, found: Words | None, start: int, end: int) -> bytes:
        """The codes ``start .. end`` of a chunk; words are joined by a space."""
        if found is None:
            return chunk.data[start:end].tobytes()
        return b" ".join(
            chunk.data[a:b].tobytes()
            for a, b in zip(found.starts[start:end], found.ends[start:end])
        )


@dataclass(frozen=True)
class Resolver:
    """Finds the repeated windows of contexts: ``send`` makes of a task's contexts the
    rows, of type ``schema``, that are dealt out by ``deal``; ``match`` turns what has
    met there into ``g, c, low, high``."""

    schema: str
    send: Callable[[Iterator[pa.RecordBatch], int], Iterator[pa.RecordBatch]]
    deal: Callable[[DataFrame, int], DataFrame]
    match: Callable[[Iterator[pa.RecordBatch], Unit], Iterator[pa.RecordBatch]]


def with_keys(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc, h, text, row``: the id, a hash that tells apart rows which share it, the
    text, and all other columns."""
    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() != text_column.lower()]
    text = F.coalesce(F.col(text_column), F.lit(""))
    return small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("doc"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
        F.col(text_column).isNull().alias("missing"),
        F.struct(*others).alias("row"),
    )


def packed(keyed: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """``text`` as zlib data: texts are moved in half the bytes. With ``bits``, a filter
    over ``h``, texts that it rules out are left behind."""
    shared = None if bits is None else keyed.sparkSession.sparkContext.broadcast(bits)
    fields = [f if f.name != "text" else T.StructField("text", T.BinaryType()) for f in keyed.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(may_match(shared.value, batch.column("h"))))
            texts = batch.column("text").cast(pa.binary())
            data = pa.array([zlib.compress(x.as_py() or b"", 1) for x in texts], pa.binary())
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, pa.field("text", pa.binary()), data)

    return keyed.mapInArrow(run, T.StructType(fields))


def marks(keyed: DataFrame, unit: Unit, resolve: Resolver) -> DataFrame:
    """``doc, h, marks``: for the texts that have repeats, an array of anchors, at ``at``
    and at the places ``more``, with the distances ``low`` and ``high`` of the repeated
    windows before them (see ``places``)."""
    # Larger than all ids: a text without id comes after all others.
    order = F.coalesce("doc", F.lit(2**63 - 1))
    found = keyed.select("doc", "h", "text").mapInArrow(
        lambda batches: _find_anchors(batches, unit),
        "doc bigint, h bigint, at int, more array<int>, g bigint, c bigint",
    )
    found = found.withColumn("v", order)
    times = F.lit(1) + F.coalesce(F.array_size("more"), F.lit(0))
    cores = found.groupBy("g").agg(
        F.sum(times).alias("n"),
        F.min("v").alias("first"),
        F.max("v").alias("last"),
        (F.min("c") != F.max("c")).alias("many"),
    )
    repeated = F.col("first") < F.col("last") if unit.later_only else F.col("n") > 1
    # Stored, so that both sides of the join are plain shuffles, which adaptive execution
    # can split where a core is hot.
    cores = stored(cores.filter(repeated).select("g", "first", "many"), "cores")
    candidates = stored(found.join(cores, "g"), "anchors")

    full = [F.lit(0).alias("low"), F.lit(unit.reach).alias("high")]
    alike = candidates.filter(~F.col("many"))
    if unit.later_only:
        alike = alike.filter(F.col("v") > F.col("first"))
    alike = alike.select("doc", "h", "at", "more", *full)

    differing = candidates.filter("many")
    contexts = stored(
        differing.groupBy("g", "c").agg(
            F.sum(times).alias("n"),
            F.min("v").alias("v"),
            F.min_by(F.struct("doc", "h", "at"), F.struct("v", "h", "at")).alias("holder"),
        ),
        "contexts",
    )
    found_low_high = _resolved(keyed, contexts, unit, resolve)
    verdicts = stored(
        contexts.select("g", "c", "n", F.col("v").alias("first")).join(
            found_low_high, ["g", "c"], "left"
        ),
        "verdicts",
    )
    whole = F.col("v") > F.col("first") if unit.later_only else F.col("n") > 1
    unlike = (
        differing.select("doc", "h", "at", "more", "g", "c", "v")
        .join(verdicts, ["g", "c"])
        .filter(whole | F.col("low").isNotNull())
        .select(
            "doc",
            "h",
            "at",
            "more",
            F.when(whole, F.lit(0)).otherwise(F.col("low")).alias("low"),
            F.when(whole, F.lit(unit.reach)).otherwise(F.col("high")).alias("high"),
        )
    )
    # At most one row for each core and context of a text.
    return (
        alike.unionByName(unlike)
        .groupBy("doc", "h")
        .agg(F.collect_set(F.struct("at", "more", "low", "high")).alias("marks"))
    )


def places(found: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``at, low, high`` of a text's marks, one for each place."""
    at = [np.array([x["at"], *(x["more"] or ())], dtype=np.int64) for x in found]
    counts = [len(x) for x in at]
    low = np.repeat(np.array([x["low"] for x in found], dtype=np.int64), counts)
    high = np.repeat(np.array([x["high"] for x in found], dtype=np.int64), counts)
    return np.concatenate(at) if at else low, low, high


def join_marks(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """All texts, packed, with their marks (null if they have none)."""
    texts = packed(keyed).withColumnsRenamed({"doc": "d", "h": "k"})
    on = same(F.col("d"), F.col("doc")) & (F.col("k") == F.col("h"))
    return texts.join(found, on, "left").drop("doc", "h")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _find_anchors(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            hashes, starts, ends, _ = unit.split(chunk)
            found = anchors.find(hashes, starts, ends, unit.window, unit.core)
            if not len(found.at):
                continue
            at = (found.at - starts[found.text]).astype(np.int32)
            lead, others, counts = _gathered(found)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            more = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(at[others]), mask=pa.array(counts == 0)
            )
            rows = pa.array(chunk.first + found.text[lead])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch.column("doc").take(rows),
                    "h": batch.column("h").take(rows),
                    "at": pa.array(at[lead]),
                    "more": more,
                    "g": _signed(found.core[lead]),
                    "c": _signed(found.context[lead]),
                }
            )


def _gathered(found: anchors.Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text that have one core and context, together: the first of each, in
    order; all others, by the first; and how many others each first has."""
    order = np.argsort(found.context ^ mix(found.text.astype(np.uint64)), kind="stable")
    again = np.concatenate(([False], np.ones(len(order) - 1, dtype=bool)))
    for values in (found.text, found.core, found.context):
        again[1:] &= values[order[1:]] == values[order[:-1]]
    lead, others = order[~again], order[again]
    rank = np.empty(len(lead), dtype=np.int64)
    rank[np.argsort(lead)] = np.arange(len(lead))
    owner = rank[np.cumsum(~again)[again] - 1]
    counts = np.bincount(owner, minlength=len(lead))
    return np.sort(lead), others[np.argsort(owner, kind="stable")], counts


def _resolved(
    keyed: DataFrame, contexts: DataFrame, unit: Unit, resolve: Resolver
) -> DataFrame:
    """``g, c, low, high`` of the contexts some of whose windows are repeats."""
    sizes = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("contexts"))
    crowded = stored(
        sizes.filter(F.col("contexts") > GROUP_CONTEXTS).select("g"), "crowded"
    )
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return resolve.send(batches, parts)

    rest = None
    if crowded.isEmpty():
        sent = _contents(keyed, contexts, unit, send, resolve.schema)
    else:
        # Both ways share what the texts have lent, since moving the texts is dear.
        contents = stored(_contents(keyed, contexts, unit, pack, CONTENT), "contents")
        few = contents.join(crowded, "g", "left_anti")
        sent = few.mapInArrow(lambda batches: send(_unpack(batches)), resolve.schema)
        rest = contents.join(crowded, "g", "left_semi").mapInArrow(
            lambda batches: _windows(_unpack(batches), unit), _WINDOWS
        )
    found = resolve.deal(sent, parts).mapInArrow(
        lambda batches: resolve.match(batches, unit), "g bigint, c bigint, low int, high int"
    )
    return found if rest is None else found.unionByName(_by_window(rest, unit))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts overlap each other and are most of what is moved."""
    for batch in batches:
        data = [zlib.compress(x.as_py(), 1) for x in batch.column("content")]
        at = batch.schema.get_field_index("content")
        yield batch.set_column(at, batch.schema.field(at), pa.array(data, pa.binary()))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [zlib.decompress(x.as_py()) for x in batch.column("content")]
        at = batch.schema.get_field_index("content")
        yield batch.set_column(at, batch.schema.field(at), pa.array(data, pa.binary()))


def _contents(
    keyed: DataFrame,
    contexts: DataFrame,
    unit: Unit,
    send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``send`` makes of the contexts with their codes (``CONTENT``), each taken from
    the text that holds it."""
    wanted = (
        contexts.select("g", "c", "n", "v", "holder.*")
        .groupBy("doc", "h")
        .agg(F.collect_list(F.struct("at", "g", "c", "v")).alias("wanted"))
    )
    texts = packed(keyed.select("doc", "h", "text")).withColumnsRenamed({"doc": "d", "h": "k"})
    on = same(F.col("d"), F.col("doc")) & (F.col("k") == F.col("h"))
    return (
        texts.join(wanted, on)
        .select("text", "wanted")
        .mapInArrow(lambda batches: send(_cut_contexts(batches, unit)), schema)
    )


def _cut_contexts(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            text = zlib.decompress(batch.column("text")[row].as_py())
            chunk = Chunk(
                0,
                np.frombuffer(text, dtype=np.uint8),
                np.zeros(1, dtype=np.int64),
                np.array([len(text)]),
            )
            found = words(chunk, SPACED) if unit.by_words else None
            size = len(text) if found is None else len(found.starts)
            wanted = batch.column("wanted")[row].as_py()
            lefts = [min(x["at"], unit.reach) for x in wanted]
            rights = [min(size - x["at"], unit.window) for x in wanted]
            content = [
                unit.content(chunk, found, x["at"] - a, x["at"] + b)
                for x, a, b in zip(wanted, lefts, rights)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "g": pa.array([x["g"] for x in wanted], pa.int64()),
                    "c": pa.array([x["c"] for x in wanted], pa.int64()),
                    "v": pa.array([x["v"] for x in wanted], pa.int64()),
                    "left": pa.array(lefts, pa.int32()),
                    "right": pa.array(rights, pa.int32()),
                    "content": pa.array(content, pa.binary()),
                }
            )


def window_hashes(
    unit: Unit, content: list[bytes], left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some contexts: the context, the distance of the window's start
    before the anchor, and the window's hash."""
    chunk = next(chunks(pa.array(content, pa.binary()), limit=1 << 62))
    hashes, starts, _, _ = unit.split(chunk)
    low = np.maximum(0, unit.window - right)
    counts = np.maximum(0, left - low + 1)
    owner = np.repeat(np.arange(len(content)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    distance = low[owner] + within
    at = starts[owner] + left[owner] - distance
    return owner, distance, hashes.runs(at, at + unit.window)


def _windows(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        owner, distance, value = window_hashes(
            unit,
            rows.column("content").to_pylist(),
            rows.column("left").to_numpy(zero_copy_only=False),
            rows.column("right").to_numpy(zero_copy_only=False),
        )
        taken = pa.array(owner)
        yield pa.RecordBatch.from_pydict(
            {
                "g": rows.column("g").take(taken),
                "c": rows.column("c").take(taken),
                "v": rows.column("v").take(taken),
                "distance": pa.array(distance.astype(np.int32)),
                "w": _signed(value),
            }
        )


def _by_window(windows: DataFrame, unit: Unit) -> DataFrame:
    """Every window a row, spread by its own hash."""
    windows = stored(windows, "windows")
    key = ["g", "distance", "w"]
    seen = windows.groupBy(*key).agg(
        F.min("v").alias("first"), (F.min("c") != F.max("c")).alias("shared")
    )
    repeated: Column = F.col("first") < F.col("v") if unit.later_only else F.lit(True)
    return (
        windows.join(seen.filter("shared"), key)
        .filter(repeated)
        .groupBy("g", "c")
        .agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    )
