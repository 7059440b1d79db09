"""Removal of word sequences that an earlier document has, by suffix automata.

Words are split at ASCII white space and taken as they are. A word goes if it lies in
a window of ``window`` words of its document whose words also start in a document
with a smaller id. Windows are judged on the input.

Only passages that share an anchor (see ``repeats``) can repeat each other. So the
reference is cut into shards, one for each core that documents share, and a shard's
contexts go to one task: in the order of the documents that first had them, each is
streamed through the suffix automaton of those before it, which gives for every word
how long a sequence ending there occurs earlier (its matching statistic), and is then
added to the automaton. Statistics of ``window`` and more are repeats. What cannot
reach that length, because its windows' hashes are all different, is left out of the
automaton. Sending every shard to every document instead would need work that grows
with the square of the corpus.

Defined results: a null or blank text has no words; a document without id counts as
having the largest id of all; documents with equal ids do not precede each other;
columns of the texts are kept, save those with the name of a result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.arrays import SPACED, Chunk, covered, spans_of, words
from millrace.llm.repeats import (
    CONTENT,
    Resolver,
    Unit,
    join_marks,
    marks,
    pack,
    places,
    window_hashes,
    with_keys,
)

WINDOW = 50
GROUP_BYTES = 1_000_000


class SuffixAutomaton:
    """All factors of the sequences added so far."""

    def __init__(self):
        self.next: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: Sequence[Hashable]) -> None:
        last = 0
        for code in sequence:
            last = self._extend(last, code)

    def _extend(self, last: int, code: Hashable) -> int:
        target = self.next[last].get(code)
        if target is not None and self.length[target] == self.length[last] + 1:
            return target
        if target is not None:
            return self._split(last, code, target)
        state = self._state({}, self.length[last] + 1)
        at = last
        while at != -1 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            target = self.next[at][code]
            if self.length[target] == self.length[at] + 1:
                self.link[state] = target
            else:
                self.link[state] = self._split(at, code, target)
        return state

    def _split(self, at: int, code: Hashable, target: int) -> int:
        """A copy of ``target`` for the shorter of its factors."""
        copy = self._state(dict(self.next[target]), self.length[at] + 1)
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at != -1 and self.next[at].get(code) == target:
            self.next[at][code] = copy
            at = self.link[at]
        return copy

    def _state(self, moves: dict, length: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        return len(self.length) - 1

    def matching(self, sequence: Sequence[Hashable]) -> Iterator[int]:
        """For each place the length of the longest factor that ends there."""
        state, length = 0, 0
        for code in sequence:
            while state and code not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if code in self.next[state]:
                state = self.next[state][code]
                length += 1
            yield length


def remove_earlier(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    window: int = WINDOW,
    with_kept: bool = True,
) -> DataFrame:
    """``docs`` without the text, but with ``n_words``, ``n_removed``, ``kept_sha256``
    of the kept words joined by one space and, if ``with_kept``, ``spans`` (ranges of
    words removed) and ``kept`` (those words, null where the text is)."""
    unit = Unit(by_words=True, window=window, core=max(window // 2, 1), later_only=True)
    keyed = with_keys(docs, id_column, text_column)
    marked = join_marks(keyed, marks(keyed, unit, _RESOLVE))
    fields = "n_words bigint, n_removed bigint, kept_sha256 string"
    if with_kept:
        fields += ", spans array<struct<first: int, last: int>>, kept string"
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
            data = np.frombuffer(text, dtype=np.uint8)
            found = words(Chunk(0, data, np.zeros(1, np.int64), np.array([len(text)])), SPACED)
            size = len(found.starts)
            at, low, high = places(batch.column("marks")[row].as_py() or [])
            gone = covered(
                size, np.maximum(at - high, 0), np.minimum(at - low + unit.window, size)
            )
            kept = b" ".join(
                text[a:b] for a, b in zip(found.starts[~gone], found.ends[~gone])
            )
            made["n_words"].append(size)
            made["n_removed"].append(int(gone.sum()))
            made["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_kept:
                first, last = spans_of(gone)
                made["spans"].append(
                    [{"first": int(a), "last": int(b)} for a, b in zip(first, last)]
                )
                missing = batch.column("missing")[row].as_py()
                made["kept"].append(None if missing else kept.decode(errors="replace"))
        kinds = [pa.int64(), pa.int64(), pa.string()]
        if with_kept:
            span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
            kinds += [pa.list_(span), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row")] + [pa.array(made[n], k) for n, k in zip(names[1:], kinds)],
            names=names,
        )


def _deal(contexts: DataFrame, parts: int) -> DataFrame:
    return contexts.repartition(parts, "g").sortWithinPartitions("g", "v", "c")


def _send(batches: Iterator[pa.RecordBatch], _parts: int) -> Iterator[pa.RecordBatch]:
    return pack(batches)


def _shards(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            before = held[-1] if held else None
            if before and before["g"] != row["g"] and size >= GROUP_BYTES:
                yield from _match(held, unit)
                held, size = [], 0
            # Rows that repeat a text lend the same context again.
            if not before or (before["g"], before["c"]) != (row["g"], row["c"]):
                row["content"] = zlib.decompress(row["content"])
                size += len(row["content"])
                held.append(row)
    if held:
        yield from _match(held, unit)


def _match(held: list[dict], unit: Unit) -> Iterator[pa.RecordBatch]:
    """Matching statistics within each shard; ``held`` has its contexts in order."""
    left = np.array([row["left"] for row in held])
    right = np.array([row["right"] for row in held])
    owner, distance, value = window_hashes(
        unit, [row["content"] for row in held], left, right
    )
    shard = np.array([row["g"] for row in held])
    order = np.lexsort((value, distance, shard[owner]))
    alike = np.zeros(len(owner) + 1, dtype=bool)
    if len(owner) > 1:
        a, b = order[1:], order[:-1]
        alike[1:-1] = (
            (value[a] == value[b])
            & (distance[a] == distance[b])
            & (shard[owner[a]] == shard[owner[b]])
        )
    shared = order[alike[1:] | alike[:-1]]
    low = np.full(len(held), np.iinfo(np.int64).max)
    high = np.full(len(held), -1)
    np.minimum.at(low, owner[shared], distance[shared])
    np.maximum.at(high, owner[shared], distance[shared])

    rows: list[dict] = []
    automaton, current, waiting, wait_v = None, None, [], None
    for i in np.flatnonzero(high >= 0):
        row = held[i]
        if row["g"] != current:
            automaton, current, waiting, wait_v = SuffixAutomaton(), row["g"], [], row["v"]
            known: set = set()
        # Only the words that shared windows cover can lie in a repeat.
        first = int(left[i] - high[i])
        span = tuple(
            row["content"].split(b" ")[first : int(left[i] - low[i]) + unit.window]
        )
        if row["v"] != wait_v:
            for sequence in waiting:
                automaton.add(sequence)
            waiting, wait_v = [], row["v"]
        ends = [
            place for place, length in enumerate(automaton.matching(span))
            if length >= unit.window
        ]
        # A window ending at ``place`` starts ``distance`` before the anchor.
        found = [int(high[i]) - (place + 1 - unit.window) for place in ends]
        found = [d for d in found if 0 <= d <= unit.reach]
        if found:
            rows.append({"g": row["g"], "c": row["c"], "low": min(found), "high": max(found)})
        if span not in known:
            known.add(span)
            waiting.append(span)
    schema = pa.schema(
        [("g", pa.int64()), ("c", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]
    )
    yield pa.RecordBatch.from_pylist(rows, schema=schema)


# Which windows of each context occur in a context of an earlier document.
_RESOLVE = Resolver(CONTENT, _send, _deal, _shards)
