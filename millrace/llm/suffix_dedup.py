"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if it lies in a string of ``window`` bytes that also starts anywhere else
in the corpus, the same text included; strings never reach from one text into the
next. The suffixes that are sorted start at anchors (see ``anchors``): every repeat
of ``window`` bytes holds one at the same place in all its occurrences, so sorting
these few suffixes finds all of them, and the corpus is not sent around 400-fold.

Each task sorts the suffixes of its texts and front-codes them as runs; runs are
exchanged by core, so that all suffixes which share one meet; and a tree of losers
merges them without comparing known prefixes again. Neighbours in that order give the
longest prefix each suffix shares with any other; where it can reach ``window`` bytes
together with what lies before the anchor, the windows are compared.

Defined results: a null text is empty; texts shorter than ``window`` keep all; rows
repeated in full are occurrences of their own, so all of each that is long enough
goes; columns of the texts are kept, save those with the name of a result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrays import covered, spans_of
from millrace.llm.repeats import (
    Resolver,
    Unit,
    join_marks,
    marks,
    places,
    window_hashes,
    with_keys,
)
from millrace.llm.suffix_runs import decode_run, front_code, merge

WINDOW = 400
RUN_BYTES = 8_000_000  # suffixes that a task sorts at a time
BLOCK = 500  # suffixes of a run that travel as one row
GROUP_BYTES = 1_000_000  # contexts that are compared at a time
_BLOCKS = (
    "part int, run bigint, block int, heads array<struct<g: bigint, c: bigint, "
    "left: int, right: int, shared: int, rest: int>>, content binary"
)


def remove_repeats(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    window: int = WINDOW,
    with_kept: bool = True,
) -> DataFrame:
    """``docs`` without the text, but with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` and, if ``with_kept``, ``spans`` (byte
    ranges removed), ``kept``, the remaining bytes, and ``kept_text``, the same as text:
    where a cut falls within a character, the rest of it goes too. Both are null where
    the text is."""
    unit = Unit(by_words=False, window=window, core=window // 2, later_only=False)
    keyed = with_keys(docs, id_column, text_column)
    marked = join_marks(keyed, marks(keyed, unit, _RESOLVE))
    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_kept:
        fields += ", spans array<struct<start: int, end: int>>, kept binary, kept_text string"
    new = T.StructType.fromDDL(fields)
    schema = T.StructType([marked.schema["row"], *new.fields])
    done = marked.select("row", "text", "missing", "marks").mapInArrow(
        lambda batches: _remove(batches, unit, with_kept, schema.names), schema
    )
    replaced = {name.lower() for name in new.names}
    others = [
        f"row.`{name}`"
        for name in marked.schema["row"].dataType.names
        if name.lower() not in replaced
    ]
    return done.select(*others, *new.names)


def _remove(
    batches: Iterator[pa.RecordBatch], unit: Unit, with_kept: bool, names: list[str]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made: dict[str, list] = {name: [] for name in names[1:]}
        for row in range(batch.num_rows):
            text = zlib.decompress(batch.column("text")[row].as_py())
            at, low, high = places(batch.column("marks")[row].as_py() or [])
            gone = covered(
                len(text),
                np.maximum(at - high, 0),
                np.minimum(at - low + unit.window, len(text)),
            )
            starts, ends = spans_of(gone)
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            made["n_bytes"].append(len(text))
            made["n_removed"].append(len(text) - len(kept))
            made["n_spans"].append(len(starts))
            made["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_kept:
                missing = batch.column("missing")[row].as_py()
                made["spans"].append(
                    [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)]
                )
                made["kept"].append(None if missing else kept)
                made["kept_text"].append(None if missing else kept.decode(errors="ignore"))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if with_kept:
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            kinds += [pa.list_(span), pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row")] + [pa.array(made[n], k) for n, k in zip(names[1:], kinds)],
            names=names,
        )


def _deal(blocks: DataFrame, parts: int) -> DataFrame:
    return blocks.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", "run", "block"
    )


def _runs(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted, front-coded runs of the suffixes that come in, one for each part."""
    task = TaskContext.get().partitionId()
    held: list[tuple] = []
    size, made = 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append((row["g"], row["c"], row["left"], row["right"], row["content"]))
            size += len(row["content"])
            if size >= RUN_BYTES:
                yield from _one_run(held, (task << 20) + made, parts)
                held, size, made = [], 0, made + 1
    yield from _one_run(held, (task << 20) + made, parts)


def _key(content: bytes, left: int) -> bytes:
    """What is compared: from the anchor on, then what lies before it, backwards."""
    return content[left:] + content[:left][::-1]


def _one_run(held: list[tuple], run: int, parts: int) -> Iterator[pa.RecordBatch]:
    by_part: dict[int, list] = {}
    for g, c, left, right, content in held:
        by_part.setdefault(g % parts, []).append((_key(content, left), g, c, left, right))
    for part, entries in by_part.items():
        entries.sort()
        coded = list(front_code(entry[0] for entry in entries))
        rows = []
        for start in range(0, len(entries), BLOCK):
            span = slice(start, start + BLOCK)
            rows.append(
                {
                    "part": part,
                    "run": run,
                    "block": start // BLOCK,
                    "heads": [
                        {"g": g, "c": c, "left": left, "right": right,
                         "shared": shared, "rest": len(rest)}
                        for (_, g, c, left, right), (shared, rest) in zip(
                            entries[span], coded[span]
                        )
                    ],
                    "content": zlib.compress(b"".join(rest for _, rest in coded[span]), 1),
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK_SCHEMA)


_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("run", pa.int64()),
        ("block", pa.int32()),
        (
            "heads",
            pa.list_(
                pa.struct(
                    [("g", pa.int64()), ("c", pa.int64())]
                    + [(name, pa.int32()) for name in ("left", "right", "shared", "rest")]
                )
            ),
        ),
        ("content", pa.binary()),
    ]
)


def _merge_runs(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    """Merge the runs of a part; compare the windows of suffixes that share a core."""
    by_run: dict[int, list] = {}
    for batch in batches:
        for row in range(batch.num_rows):
            by_run.setdefault(batch.column("run")[row].as_py(), []).append(batch.slice(row, 1))
    runs = [decode_run(_entries(blocks)) for blocks in by_run.values()]
    group: list[list] = []  # key, shared with the one before, head
    held: list[list[list]] = []
    size = 0
    for key, shared, head in merge(runs):
        if not group or shared < unit.core:
            if len(group) > 1:
                held.append(group)
                size += sum(len(entry[0]) for entry in group)
                if size >= GROUP_BYTES:
                    yield from _compare(held, unit)
                    held, size = [], 0
            group = []
        # Rows that repeat a text lend the same context again.
        if not group or (head["g"], head["c"]) != (group[-1][2]["g"], group[-1][2]["c"]):
            group.append([key, shared, head])
    if len(group) > 1:
        held.append(group)
    if held:
        yield from _compare(held, unit)


def _entries(blocks: list[pa.RecordBatch]) -> Iterator[tuple[int, bytes, dict]]:
    for block in blocks:
        content = zlib.decompress(block.column("content")[0].as_py())
        at = 0
        for head in block.column("heads")[0].as_py():
            yield head["shared"], content[at : at + head["rest"]], head
            at += head["rest"]


def _compare(groups: list[list[list]], unit: Unit) -> Iterator[pa.RecordBatch]:
    """Of suffixes with equal cores: the windows that two or more of them have."""
    content, left, right, group_of, heads, longest = [], [], [], [], [], []
    for number, group in enumerate(groups):
        shared = [entry[1] for entry in group[1:]]
        # The longest prefix shared with any other is that with a neighbour.
        best = [max(a, b) for a, b in zip([0, *shared], [*shared, 0])]
        for (key, _, head), most in zip(group, best):
            after = head["right"]
            if head["left"] + min(most, after) < unit.window:
                continue  # no window reaches far enough to be shared
            content.append(key[after:][::-1] + key[:after])
            left.append(head["left"])
            right.append(after)
            group_of.append(number)
            heads.append(head)
            longest.append(most)
    if not content:
        return
    group_of = np.array(group_of)
    owner, distance, value = window_hashes(unit, content, np.array(left), np.array(right))
    reachable = unit.window - distance <= np.array(longest)[owner]
    owner, distance, value = owner[reachable], distance[reachable], value[reachable]
    order = np.lexsort((group_of[owner], distance, value))
    owner, distance, value = owner[order], distance[order], value[order]
    alike = np.zeros(len(owner) + 1, dtype=bool)
    alike[1:-1] = (
        (value[1:] == value[:-1])
        & (distance[1:] == distance[:-1])
        & (group_of[owner[1:]] == group_of[owner[:-1]])
    )
    repeated = alike[1:] | alike[:-1]
    owner, distance = owner[repeated], distance[repeated]
    low = np.full(len(heads), np.iinfo(np.int32).max, dtype=np.int32)
    high = np.full(len(heads), -1, dtype=np.int32)
    np.minimum.at(low, owner, distance.astype(np.int32))
    np.maximum.at(high, owner, distance.astype(np.int32))
    found = np.flatnonzero(high >= 0)
    yield pa.RecordBatch.from_pydict(
        {
            "g": pa.array([heads[i]["g"] for i in found], pa.int64()),
            "c": pa.array([heads[i]["c"] for i in found], pa.int64()),
            "low": pa.array(low[found]),
            "high": pa.array(high[found]),
        }
    )


# Which windows of each context occur in another, by merging sorted suffixes.
_RESOLVE = Resolver(_BLOCKS, _runs, _deal, _merge_runs)
