"""Phrases whose words belong together, counted by prefix-free parsing.

* Parsing: the words of each piece of text are cut into *chunks* where the words
  themselves say so: wherever a hash of ``longest - 1`` consecutive words is divisible by
  ``TRIGGER``, a chunk ends with these words and the next one begins with them. Equal
  passages are cut alike wherever they are. Distinct chunks, with how often the parse has
  each, are the dictionary; everything after it goes by distinct chunks.
* Counting: the phrases inside a distinct chunk count as often as the chunk. A phrase that
  starts in the words two chunks share is counted in the second one only, so each
  occurrence counts once.
* A first pass over the dictionary adds up counts by hashes alone, which can only be too
  high; a second one adds up, by their words, the phrases that may be frequent enough. So
  rare phrases, nearly all of them, are never moved as text. The hashes grow with the
  corpus, so that no more than one in a thousand meets another. The first pass's outcome
  travels as a table of bits whose size has a bound; when there are more frequent phrases
  than it can tell apart, more rare ones are moved as well, and dropped then.

Pieces lie between the bytes of ``BREAKS``; words, in which A-Z are lower case, between
spaces and tabs. Everything is counted within a group (language); a null group is
``und``. A phrase's parts are at least as frequent as the phrase, so whatever a score
needs has been counted. Scores are exact: decimals of 38 digits, enough for counts up to
10^15; beyond that the query fails instead of rounding.

Defined results: null, empty and blank texts have no words; repeated rows count as often
as they are there; bytes that are no UTF-8 are bytes like others; an empty table has no
phrases; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.arrays import (
    Chunk,
    Hashes,
    byte_table,
    chunks,
    gathered,
    lowered,
    mix,
    text_of_word,
    words,
)
from millrace.llm.frames import small_batches, stored

TRIGGER = 8
LEAST = 10  # occurrences of a candidate
INSIDE = 50  # per cent of a phrase's occurrences that a longer one must have to replace it
TOP = 2000
# What pieces end at, as bytes, and what words end at.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_SPACES = byte_table([(0x20, 0x20), (0x09, 0x09)])
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True
_IN_WORD = _SPACES & ~_IS_BREAK

_PHRASES = 1_000_000  # that a task adds up at a time
_BLOCK = 2_000_000  # hashes that are added up at a time, and that a bucket has, about
_LOW = 32  # bits of a hash within its bucket
_MAX_BITS = 1 << 28  # of the table of frequent hashes, 32 MB
_GRAM = "grp string, size int, phrase binary, n bigint"


def parse(
    docs: DataFrame, text_column: str, group_column: str, longest: int = 3, trigger: int = TRIGGER
) -> DataFrame:
    """The dictionary: ``grp, last, chunk, n_words, n``. ``chunk`` is its words joined by
    one space, ``last`` whether a piece ends with it, ``n`` how often the parse has it."""
    rows = small_batches(docs).select(
        F.coalesce(F.col(group_column).cast("string"), F.lit("und")).alias("grp"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    overlap = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found, last, n_words, row = _cut(lowered(chunk), overlap, trigger)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("grp").take(pa.array(row + chunk.first)),
                        pa.array(last),
                        found,
                        pa.array(n_words, pa.int32()),
                    ],
                    names=["grp", "last", "chunk", "n_words"],
                )

    parsed = rows.mapInArrow(run, "grp string, last boolean, chunk binary, n_words int")
    return parsed.groupBy("grp", "last", "chunk", "n_words").agg(F.count(F.lit(1)).alias("n"))


def _cut(
    chunk: Chunk, overlap: int, trigger: int
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The chunks of some texts, whether each ends a piece, its words and its text."""
    found = words(chunk, _IN_WORD)
    n = len(found.starts)
    text = text_of_word(found)
    breaks = np.cumsum(_IS_BREAK[chunk.data])
    piece = breaks[found.starts] if n else np.zeros(0, np.int64)
    begins = np.ones(n, dtype=bool)
    begins[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    # The piece's end, as a word number, for each word.
    firsts = np.flatnonzero(begins)
    ends = np.append(firsts[1:], n)[: len(firsts)]
    end = np.repeat(ends, ends - firsts)
    # A trigger is a whole window of words within the piece, not at its start.
    code = Hashes.of_bytes(chunk.data).runs(found.starts, found.ends)
    window = code.copy()
    for k in range(1, overlap):
        size = max(n - k, 0)
        window[:size] = mix(window[:size] * np.uint64(3) + code[k:])
    cut = np.zeros(n, dtype=bool)
    if overlap:
        whole = np.arange(n) + overlap <= end
        cut = whole & ~begins & (mix(window) % np.uint64(trigger) == 0)
    start = np.flatnonzero(begins | cut)
    last = np.ones(len(start), dtype=bool)
    last[:-1] = begins[start[1:]]
    stop = end[start]
    stop[~last] = start[np.flatnonzero(~last) + 1] + overlap
    # One buffer of all words, each followed by a space; a chunk is a run of it.
    sizes = found.ends - found.starts + 1
    at = np.concatenate(([0], np.cumsum(sizes)))
    joined = np.full(at[-1], 0x20, dtype=np.uint8)
    source = np.arange(at[-1]) + np.repeat(found.starts - at[:-1], sizes)
    inside = np.ones(at[-1], dtype=bool)
    inside[at[1:] - 1] = False
    joined[inside] = chunk.data[source[inside]]
    return gathered(joined, at[start], at[stop] - 1), last, stop - start, text[start]


class _Grams:
    """All phrases that the chunks of a batch own: word ranges, hashes and weights."""

    def __init__(self, batch: pa.RecordBatch, part: Chunk, longest: int):
        self.data = part.data
        rows = slice(part.first, part.first + len(part.starts))
        number = lambda name: batch.column(name).to_numpy(zero_copy_only=False)[rows]
        last, n = number("last"), number("n").astype(np.int64)
        self.words = words(part, _SPACES)
        self.row = text_of_word(self.words)
        self.weight = n[self.row]
        index = np.arange(len(self.row))
        self.end = self.words.last[self.row]
        owned = self.end - np.where(last[self.row], 0, longest - 1)
        self.hashes = Hashes.of_bytes(self.data)
        groups = batch.column("grp").dictionary_encode()
        seeds = [
            int.from_bytes(hashlib.blake2b((g or "").encode(), digest_size=8).digest(), "big")
            for g in groups.dictionary.to_pylist()
        ]
        code = groups.indices.to_numpy(zero_copy_only=False)[rows]
        self.seed = np.array(seeds, dtype=np.uint64)[code][self.row]
        self.group = batch.column("grp").slice(part.first, len(part.starts))
        self.index, self.owned = index, owned

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of the phrases of so many words, and the phrases' hashes."""
        first = self.index[(self.index < self.owned) & (self.index + size <= self.end)]
        hashed = self.hashes.runs(self.words.starts[first], self.words.ends[first + size - 1])
        return first, mix(hashed ^ (self.seed[first] + np.uint64(size)))

    def texts(self, first: np.ndarray, size: int) -> pa.Array:
        return gathered(self.data, self.words.starts[first], self.words.ends[first + size - 1])


def _frequent(dictionary: DataFrame, longest: int, least: int) -> tuple[np.ndarray, int]:
    """A table of bits, which hashes' phrases may occur ``least`` times, and of how many
    high bits of a hash it was made."""
    own = F.col("n_words") - F.when(F.col("last"), 0).otherwise(longest - 1)
    found = dictionary.agg(F.sum(own.cast("bigint"))).first()[0] or 0
    tasks = dictionary.sparkSession.sparkContext.defaultParallelism
    buckets = 1 << max(found * longest // _BLOCK, 2 * tasks).bit_length()
    used = buckets.bit_length() - 1 + _LOW

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch.column("chunk")):
                grams = _Grams(batch, part, longest)
                for n_words in range(1, longest + 1):
                    first, hashed = grams.of(n_words)
                    held.append((_high(hashed, used), grams.weight[first]))
                    size += len(first)
                if size >= _PHRASES:
                    yield from _bucketed(*_added(held), buckets)
                    held, size = [], 0
        if size:
            yield from _bucketed(*_added(held), buckets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        for batch in batches:
            for row in batch.to_pylist():
                low = np.frombuffer(row["low"], "<u4").astype(np.uint64)
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                held.append((low + np.uint64(row["bucket"] << _LOW), counts))
                size += len(low)
                if size >= _BLOCK:
                    held, size = [_added(held)], 0
        keys, counts = _added(held)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys[counts >= least].view(np.int64))})

    sent = dictionary.select("grp", "last", "chunk", "n").mapInArrow(
        count, "bucket int, low binary, counts binary"
    )
    keys = stored(
        sent.repartitionById(buckets, F.col("bucket")).mapInArrow(add, "key bigint"),
        "frequent-hashes",
    )
    return _bits(keys, keys.count()), used


def _high(hashed: np.ndarray, used: int) -> np.ndarray:
    return hashed >> np.uint64(64 - used)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts added up."""
    keys, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _bucketed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    bounds = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(_LOW)
    places = np.searchsorted(keys, bounds)
    full = np.flatnonzero(places[1:] > places[:-1])
    # A count that is cut off here is enough whatever is asked for.
    low, counts = keys.astype("<u4"), np.minimum(counts, 2**32 - 1).astype("<u4")
    for start in range(0, len(full), 256):
        part = full[start : start + 256]
        spans = [slice(places[b], places[b + 1]) for b in part]
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(part, pa.int32()),
                "low": pa.array([low[span].tobytes() for span in spans], pa.binary()),
                "counts": pa.array([counts[span].tobytes() for span in spans], pa.binary()),
            }
        )


def _bits(keys: DataFrame, n: int) -> np.ndarray:
    """A byte table with a bit for each key; at most ``_MAX_BITS`` bits, whatever ``n``."""
    size = min(_MAX_BITS, 1 << max(16, (16 * n).bit_length()))
    segment = min(size, 1 << 19)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            places = _places(batch.column("key").to_numpy(zero_copy_only=False), size)
            for s in np.unique(places // segment).tolist():
                bits = parts.setdefault(s, np.zeros(segment, dtype=bool))
                bits[places[places // segment == s] % segment] = True
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array(list(parts), pa.int32()),
                "bits": pa.array([np.packbits(b).tobytes() for b in parts.values()], pa.binary()),
            }
        )

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bits = np.frombuffer(row["bits"], np.uint8)
                parts[row["segment"]] = parts.get(row["segment"], 0) | bits
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array(list(parts), pa.int32()),
                "bits": pa.array([b.tobytes() for b in parts.values()], pa.binary()),
            }
        )

    fields = "segment int, bits binary"
    found = keys.mapInArrow(mark, fields).repartition(16, "segment").mapInArrow(unite, fields)
    table = np.zeros(size // 8, dtype=np.uint8)
    for row in found.collect():
        at = row["segment"] * (segment // 8)
        table[at : at + segment // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)


def count_phrases(dictionary: DataFrame, longest: int = 3, least: int = LEAST) -> DataFrame:
    """``grp, size, phrase, n`` for all phrases of up to ``longest`` words that occur
    ``least`` times; the dictionary should be stored."""
    bits, used = _frequent(dictionary, longest, least)
    shared = dictionary.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch.column("chunk")):
                grams = _Grams(batch, part, longest)
                for n_words in range(1, longest + 1):
                    first, hashed = grams.of(n_words)
                    places = _places(_high(hashed, used), 8 * len(table))
                    bit = table[places >> 3] >> (7 - (places & 7)).astype(np.uint8)
                    first = first[bit & 1 == 1]
                    held.append(
                        pa.RecordBatch.from_arrays(
                            [
                                grams.group.take(pa.array(grams.row[first])),
                                pa.array(np.full(len(first), n_words, np.int32)),
                                grams.texts(first, n_words),
                                pa.array(grams.weight[first]),
                            ],
                            names=["grp", "size", "phrase", "n"],
                        )
                    )
                    size += len(first)
                if size >= _PHRASES // 4:
                    yield from _grouped(held)
                    held, size = [], 0
        if size:
            yield from _grouped(held)

    rows = dictionary.select("grp", "last", "chunk", "n").mapInArrow(run, _GRAM)
    return (
        rows.groupBy("grp", "size", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .select("grp", "size", F.col("phrase").cast("string").alias("phrase"), "n")
    )


def _grouped(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal phrases of a group added up, by their bytes."""
    table = pa.Table.from_batches(held).combine_chunks()
    phrases, groups = (table.column(x).chunk(0).dictionary_encode() for x in ("phrase", "grp"))
    code = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    code = code * len(phrases.dictionary) + phrases.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
    counts = np.add.reduceat(table.column("n").to_numpy()[order], first)
    rows = table.select(["grp", "size", "phrase"]).take(pa.array(order[first]))
    rows = rows.append_column("n", pa.array(counts))
    yield from rows.combine_chunks().to_batches(max_chunksize=50_000)


def _first_words(n: str) -> Column:
    """So many words of ``phrase``, from its end if negative, by bytes."""
    return F.expr(f"substring_index(phrase, ' ', {n})")


def score() -> Column:
    """``floor(10^6 * a * a / (l * r))`` of the columns ``a, l, r``, exactly."""
    return F.expr(
        "(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    )


def collocations(
    docs: DataFrame,
    text_column: str,
    group_column: str,
    longest: int = 3,
    least: int = LEAST,
    inside: int = INSIDE,
    top: int = TOP,
    trigger: int = TRIGGER,
) -> DataFrame:
    """Each group's first ``top`` phrases: ``grp, rank, phrase, a, l, r, n, score``.

    ``a`` is how often a phrase occurs, ``n`` the group's words. Cutting it in two, with
    ``l`` and ``r`` occurrences, scores ``floor(10^6 * a * a / (l * r))``; the cut that
    scores least counts, the first of equals. A phrase inside a longer candidate with at
    least ``inside`` per cent of its occurrences is left out. Order: score, then ``a``,
    both descending, then the phrase's bytes.
    """
    dictionary = stored(parse(docs, text_column, group_column, longest, trigger), "chunks")
    counts = stored(count_phrases(dictionary, longest, least), "phrases")
    own = F.col("n_words") - F.when(F.col("last"), 0).otherwise(longest - 1)
    totals = dictionary.groupBy("grp").agg(F.sum(own * F.col("n")).alias("total"))

    candidates = counts.filter(F.col("size") >= 2).withColumnRenamed("n", "a")
    cuts = candidates.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "grp", "phrase", "a", "k",
        _first_words("k").alias("left"),
        _first_words("k - size").alias("right"),
    )
    of = lambda side, n: counts.select("grp", F.col("phrase").alias(side), F.col("n").alias(n))
    scored = (
        cuts.join(of("left", "l"), ["grp", "left"])
        .join(of("right", "r"), ["grp", "right"])
        .select("grp", "phrase", "a", F.struct(score().alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("grp", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
    )
    longer = (
        candidates.filter(F.col("size") > 2)
        .select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("within"))
        .select(
            "*",
            F.explode(F.sequence(F.col("within"), F.col("size"))).alias("end"),
        )
        .withColumn("phrase", _first_words("end"))
        .select("grp", "a", _first_words("-within").alias("phrase"))
        .groupBy("grp", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    wide = lambda name, by: F.col(name).cast("decimal(20,0)") * by
    kept = scored.join(longer, ["grp", "phrase"], "left").filter(
        F.col("longer").isNull() | (wide("longer", 100) < wide("a", inside))
    )
    order = Window.partitionBy("grp").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()
    )
    ranked = (
        kept.select("grp", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )
    return ranked.join(totals, "grp").select(
        "grp", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score",
    )
