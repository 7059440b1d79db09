"""Benchmark decontamination: a broadcast hash set of the benchmark's n-grams is held
against every window of words of the training texts; hits are verified word for word.

Words are runs of digits, lower-case letters (A-Z count as lower-case) and anything
beyond ASCII. An item's windows are its runs of ``n`` words; an item with fewer words
is one window. A word of a text is *hit* if it lies in an occurrence of a window.

The broadcast holds at most ``max_windows`` windows. A larger benchmark is split by a
hash into blocks of that size, and the texts are scanned once for each, with the hits
so far carried along and stored in between; the result is the same.

Defined results: a null or empty text has no words and no hits; an item without words
has no windows; an item whose id is null marks words but is not listed; repeated rows
give repeated results; without items nothing is hit. Other columns of the texts are
kept, save those that have the name of a result column, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import (
    ALPHANUMERIC,
    Chunk,
    Hashes,
    Words,
    chunks,
    covered,
    lowered,
    spans_of,
    text_of_word,
    words,
)
from millrace.llm.frames import add_columns, small_batches, stored

MAX_WINDOWS = 200_000
MAX_BYTES = 64 << 20  # of windows and item ids that are broadcast at once
_RESULT = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "hit_spans array<struct<first: int, last: int>>"
)


@dataclass
class WindowSet:
    """Windows of one block, sorted by hash."""

    lengths: list[int]
    hashes: np.ndarray
    grams: list[bytes]
    items: list[str | None]

    def __post_init__(self):
        # One bit in 2^20 per window: most windows of a text miss it and go no further.
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.hashes & np.uint64((1 << 20) - 1)] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.maybe[hashes & np.uint64((1 << 20) - 1)])
        place = np.searchsorted(self.hashes, hashes[at])
        place[place == len(self.hashes)] = 0
        return at[self.hashes[place] == hashes[at]]

    def matches(self, value: np.uint64, gram: bytes) -> list[str | None]:
        """Items of the windows that are this very gram."""
        found = []
        at = int(np.searchsorted(self.hashes, value))
        while at < len(self.hashes) and self.hashes[at] == value:
            if self.grams[at] == gram:
                found.append(self.items[at])
            at += 1
        return found


def item_windows(items: DataFrame, id_column: str, text_column: str, n: int) -> DataFrame:
    """Distinct ``item, gram, length``: the words of each window joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in map(lowered, chunks(batch.column("text"))):
                found = words(chunk, ALPHANUMERIC)
                for i in range(len(chunk.starts)):
                    text = found.of(chunk, i)
                    if not text:
                        continue
                    size = min(n, len(text))
                    grams = {
                        b" ".join(text[j : j + size])
                        for j in range(len(text) - size + 1)
                    }
                    item = batch.column("item")[chunk.first + i].as_py()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item": pa.array([item] * len(grams), pa.string()),
                            "gram": pa.array(sorted(grams), pa.binary()),
                            "length": pa.array([size] * len(grams), pa.int32()),
                        }
                    )

    source = small_batches(items).select(
        F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text")
    )
    return source.mapInArrow(run, "item string, gram binary, length int").distinct()


def find_contamination(
    docs: DataFrame,
    text_column: str,
    items: DataFrame,
    item_column: str,
    item_text_column: str,
    n: int = 10,
    max_windows: int = MAX_WINDOWS,
    max_bytes: int = MAX_BYTES,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``; ``n_hit``, the words hit; ``items``, the ids as
    strings, sorted, of the items with an occurring window; ``hit_spans``, the maximal
    runs of hit words (first, and one past the last); and, if ``with_text``,
    ``clean_text``, the text without those runs (null stays null)."""
    windows = stored(item_windows(items, item_column, item_text_column, n), "windows")
    size = F.octet_length("gram") + F.coalesce(F.octet_length("item"), F.lit(0)) + 8
    count, total = windows.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    blocks = max(-(-count // max_windows), -(-(total or 0) // max_bytes), 1)
    block = F.pmod(F.xxhash64("item", "gram"), F.lit(blocks))
    for number in range(blocks):
        chosen = windows.filter(block == number).collect()
        known = _window_set(chosen)
        last = number == blocks - 1
        found = _scan(docs, text_column, known, number > 0, with_text and last)
        docs = found if last else stored(found, "hits")
    return docs


def _window_set(rows: list) -> WindowSet:
    grams = [bytes(row["gram"]) for row in rows]
    values = np.zeros(len(rows), dtype=np.uint64)
    for at, gram in enumerate(grams):
        values[at] = _gram_hash(gram, rows[at]["length"])
    order = np.argsort(values, kind="stable")
    return WindowSet(
        sorted({row["length"] for row in rows}),
        values[order],
        [grams[i] for i in order],
        [rows[i]["item"] for i in order],
    )


def _gram_hash(gram: bytes, length: int) -> np.uint64:
    chunk = next(chunks(pa.array([gram], pa.binary())))
    return Hashes(_word_codes(chunk, words(chunk, ALPHANUMERIC))).grams(length)[0]


def _word_codes(chunk: Chunk, found: Words) -> np.ndarray:
    return Hashes.of_bytes(chunk.data).runs(found.starts, found.ends)


def _scan(
    docs: DataFrame, text_column: str, windows: WindowSet, carry: bool, with_text: bool
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        known = shared.value
        texts = batch.column(text_column)
        n_words, n_hit, items, all_spans, clean = [], [], [], [], []
        for original in chunks(texts):
            chunk = lowered(original)
            found = words(chunk, ALPHANUMERIC)
            hits = _hits(chunk, found, known)
            for i in range(len(chunk.starts)):
                row = chunk.first + i
                size = int(found.last[i] - found.first[i])
                spans, named = hits.get(i, ([], set()))
                if carry:
                    spans = spans + [
                        (x["first"], x["last"]) for x in batch.column("hit_spans")[row].as_py()
                    ]
                    named = named | set(batch.column("items")[row].as_py())
                if spans:
                    mask = covered(
                        size, np.array([s[0] for s in spans]), np.array([s[1] for s in spans])
                    )
                    first, last = spans_of(mask)
                else:
                    first = last = np.zeros(0, dtype=np.int64)
                n_words.append(size)
                n_hit.append(int((last - first).sum()))
                items.append(sorted(named))
                all_spans.append([{"first": int(a), "last": int(b)} for a, b in zip(first, last)])
                if not with_text:
                    continue
                if not texts[row].is_valid:
                    clean.append(None)
                elif len(first) == 0:
                    clean.append(original.text(i).decode(errors="replace"))
                else:
                    base = found.first[i]
                    clean.append(
                        _without(
                            original, i, found.starts[base + first], found.ends[base + last - 1]
                        )
                    )
        made = {
            "n_words": pa.array(n_words, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string())),
            "hit_spans": pa.array(
                all_spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            ),
        }
        return made | ({"clean_text": pa.array(clean, pa.string())} if with_text else {})

    return add_columns(docs, _RESULT + ", clean_text string" * with_text, make)


def _hits(chunk: Chunk, found: Words, known: WindowSet) -> dict[int, tuple[list, set]]:
    """By text: spans of words, from the text's first, and items."""
    hits: dict[int, tuple[list, set]] = {}
    if not len(found.starts) or not len(known.hashes):
        return hits
    hashes = Hashes(_word_codes(chunk, found))
    owner = text_of_word(found)
    for length in known.lengths:
        grams = hashes.grams(length)
        for at in known.candidates(grams):
            text = int(owner[at])
            if at + length > found.last[text]:
                continue
            gram = b" ".join(
                chunk.data[a:b].tobytes()
                for a, b in zip(found.starts[at : at + length], found.ends[at : at + length])
            )
            matched = known.matches(grams[at], gram)
            if matched:
                spans, items = hits.setdefault(text, ([], set()))
                first = int(at - found.first[text])
                spans.append((first, first + length))
                items.update(item for item in matched if item is not None)
    return hits


def _without(chunk: Chunk, i: int, starts: np.ndarray, ends: np.ndarray) -> str:
    """A text without some byte ranges, which begin and end with whole words."""
    parts, at = [], chunk.starts[i]
    for start, end in zip(starts, ends):
        parts.append(chunk.data[at:start].tobytes())
        at = end
    parts.append(chunk.data[at : chunk.ends[i]].tobytes())
    return b"".join(parts).decode(errors="replace")
