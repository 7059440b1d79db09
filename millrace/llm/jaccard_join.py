"""Near-duplicate texts by an exact Jaccard join of their word shingles.

* Texts with equal sets of shingles are one *class*; only classes are compared.
* Shingles are ordered rare first: by a table of ``DF_SLOTS`` counts over the hashes
  of all texts' shingles (a fixed size, whatever the corpus), then by hash. Two sets
  that are similar enough share a shingle among the first of each, their prefixes, so
  only classes that share a prefix shingle are looked at.
* Of such a pair, length, the places of the shared shingle (positional filter) and the
  number of shingles that fall into each of ``SLOTS`` parts of all shingles (suffix
  filter: parts bound the overlap) must leave room for enough shared shingles.
* Pairs that pass are verified once, by the sets themselves.

First only neighbours within a prefix shingle's list are tried, which joins most
copies to their group; then all pairs of different groups are. Pairs within a group
are never listed: they cannot change it. Candidates travel as lists per class and
block of classes, not as rows; lists of a hot shingle are cut into blocks that are
compared pair by pair of blocks in different tasks.

Defined results: words are split at ASCII white space, A-Z count as lower-case; a text
with fewer words than a shingle is one shingle; a text without words (or null) has none
and is linked with nothing; rows that repeat a text are linked; null ids are passed over
when the least id of a component is taken. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import SPACED, Chunk, Hashes, chunks, lowered, mix, words
from millrace.llm.components import components
from millrace.llm.frames import key_filter, same, stored
from millrace.llm.repeats import packed, with_keys

WORDS = 5
PERCENT = 80
DF_SLOTS = 1 << 18
DF_SEGMENT = 1 << 12
SLOTS = 32
FULL = 65_535  # the largest set whose parts are counted
PREFIX_ROWS = 300_000  # prefix shingles that a task sorts
BLOCK = 2048  # classes of a prefix shingle's list that are compared with as many
KEY_BITS = 64  # of a class's key; fewer only to test what becomes of equal keys
UNIT = 32  # classes of a group whose sets are sent together to be compared


def shingle_sets(chunk: Chunk, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each text of a chunk with the sorted hashes of its distinct shingles."""
    chunk = lowered(chunk)
    found = words(chunk, SPACED)
    hashes = Hashes(Hashes.of_bytes(chunk.data).runs(found.starts, found.ends))
    grams = hashes.grams(size)
    for i, (first, last) in enumerate(zip(found.first, found.last)):
        if last - first >= size:
            yield i, np.unique(grams[first : last - size + 1])
        elif last > first:
            yield i, hashes.runs(np.array([first]), np.array([last]))
        else:
            yield i, np.zeros(0, dtype=np.uint64)


def near_duplicates(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    size: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row ``id, n_shingles, component_id``: the least id reachable over links
    between texts with ``100 * intersection >= percent * union``; also ``keep``, which
    holds for one row of each component."""
    keyed = with_keys(docs, id_column, text_column)
    texts = stored(_classes_of_texts(keyed, size), "texts")
    classes = stored(_classes(texts), "classes")
    # Keys that different sets share: none, or a few among many billions of texts. Those
    # sets go by their second hash.
    shared = frozenset(row.k for row in classes.filter("differ").select("k").collect())
    if shared:
        key = F.when(F.col("k").isin(list(shared)), F.col("check")).otherwise(F.col("k"))
        texts = texts.withColumn("k", key)
        classes = stored(_classes(texts), "classes")
        again = F.when(F.col("differ"), F.raise_error(F.lit("two sets share both hashes")))
        classes = classes.filter(again.isNull())
    lists = stored(_lists(keyed, texts, size, percent, shared), "lists")

    tried = _neighbours(lists, classes, percent)
    links = stored(_verified(keyed, classes, tried, size, percent), "links")
    groups = stored(components(links, "a", "b"), "groups")
    crossing = _between_groups(lists, classes, groups, percent)
    more = _verified(keyed, classes, crossing, size, percent)
    edges = groups.select(F.col("node").alias("a"), F.col("root").alias("b"))
    groups = stored(components(edges.unionByName(more), "a", "b"), "groups")

    grouped = classes.join(groups, classes["k"] == groups["node"], "left").select(
        "k", "doc", "h", F.coalesce("root", "k").alias("root")
    )
    # The row kept is that with the least id, nulls last, and the least hash.
    place = F.struct(F.col("doc").isNull(), "doc", "h")
    least = grouped.groupBy("root").agg(F.min(place).alias("least"))
    named = grouped.join(least, "root").select(
        F.col("k").alias("class"),
        F.col("least.doc").alias("component"),
        F.col("least.h").alias("kept_h"),
    )
    linked = texts.filter("n > 0").join(named, F.col("k") == F.col("class"))
    is_kept = same(F.col("doc"), F.col("component")) & (F.col("h") == F.col("kept_h"))
    alone = texts.filter("n = 0")
    columns = ["doc", "h", F.col("n").cast("bigint").alias("n_shingles")]
    return (
        linked.select(*columns, F.col("component").alias("component_id"), is_kept.alias("keep"))
        .unionByName(
            alone.select(*columns, F.col("doc").alias("component_id"), F.lit(True).alias("keep"))
        )
        .withColumnRenamed("doc", id_column)
    )


def keep_one(docs: DataFrame, id_column: str, text_column: str, **options) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that with the least id. Texts
    without words are linked with nothing, so all their rows stay, where they are."""
    found = near_duplicates(docs, id_column, text_column, **options)
    found = found.filter("keep and n_shingles > 0")
    # What ``SPACED`` calls a word: anything but ASCII white space.
    has_words = F.coalesce(F.col(text_column).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # An id of no row stands for null, so that rows meet by plain equality and are
    # dealt out once for both the join and the removal of repeated rows.
    id_key = lambda column: F.coalesce(column.cast("bigint"), F.lit(-(2**63)))
    kept = found.select(id_key(F.col(id_column)).alias("d"), F.col("h").alias("t"))
    text_key = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.filter(has_words).select(
        id_key(F.col(id_column)).alias("d"),
        text_key.alias("t"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )
    one = rows.join(kept, ["d", "t"], "left_semi").dropDuplicates(["d", "t"])
    return one.select("row.*").unionByName(docs.filter(~has_words))


def _classes_of_texts(keyed: DataFrame, size: int) -> DataFrame:
    """Per text its class: a sum over the hashes of its shingles, and a second one for
    different sets that have the same first."""

    bits = KEY_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                n, k, check, parts = [], [], [], []
                for _, grams in shingle_sets(chunk, size):
                    n.append(len(grams))
                    k.append(_key(grams, bits))
                    check.append(_second_key(grams))
                    parts.append(_parts(grams))
                rows = batch.slice(chunk.first, len(chunk.starts))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": rows.column("doc"),
                        "h": rows.column("h"),
                        "n": pa.array(n, pa.int32()),
                        "k": pa.array(k, pa.int64()),
                        "check": pa.array(check, pa.int64()),
                        "parts": pa.array(parts, pa.binary()),
                    }
                )

    return keyed.select("doc", "h", "text").mapInArrow(
        run, "doc bigint, h bigint, n int, k bigint, check bigint, parts binary"
    )


def _key(grams: np.ndarray, bits: int) -> int:
    total = grams.sum(dtype=np.uint64) >> np.uint64(64 - bits)
    return int(total.view(np.int64))


def _second_key(grams: np.ndarray) -> int:
    return int(mix(grams).sum(dtype=np.uint64).view(np.int64))


def _parts(grams: np.ndarray) -> bytes:
    """How many shingles fall into each part; all are ``FULL`` for a set of more than
    that, which no counted set can have, and ``_room`` then takes it as unbounded."""
    if len(grams) > FULL:
        return np.full(SLOTS, FULL, dtype=np.uint16).tobytes()
    counts = np.bincount((grams >> np.uint64(59)).astype(np.int64), minlength=SLOTS)
    return counts.astype(np.uint16).tobytes()


def _classes(texts: DataFrame) -> DataFrame:
    """``k, n, parts`` of each class and one text that has it; ``differ`` if it is not one
    class but several with the same key."""
    return (
        texts.filter("n > 0")
        .groupBy("k")
        .agg(
            F.first("n").alias("n"),
            F.first("parts").alias("parts"),
            F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "h")).alias("t"),
            (F.min("check") != F.max("check")).alias("differ"),
        )
        .select("k", "n", "parts", "t.doc", "t.h", "differ")
    )


def _frequencies(keyed: DataFrame, size: int) -> np.ndarray:
    """How many texts have a shingle in each slot, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(DF_SLOTS, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                sets = [grams for _, grams in shingle_sets(chunk, size)]
                counts += np.bincount(_slot(np.concatenate(sets)), minlength=DF_SLOTS)
        yield _segments(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], dtype=np.int64)
                sums[row["segment"]] = sums.get(row["segment"], 0) + counts
        for segment, counts in sums.items():
            yield _segment_batch([segment], [counts])

    fields = "segment int, counts binary"
    rows = (
        keyed.select("text")
        .mapInArrow(count, fields)
        .repartition(DF_SLOTS // DF_SEGMENT, "segment")
        .mapInArrow(add, fields)
        .collect()
    )
    total = np.zeros(DF_SLOTS, dtype=np.int64)
    for row in rows:
        start = row["segment"] * DF_SEGMENT
        total[start : start + DF_SEGMENT] = np.frombuffer(row["counts"], dtype=np.int64)
    return total


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(DF_SLOTS - 1)).astype(np.int64)


def _segments(counts: np.ndarray) -> pa.RecordBatch:
    parts = counts.reshape(-1, DF_SEGMENT)
    return _segment_batch(list(range(len(parts))), list(parts))


def _segment_batch(segments: list[int], counts: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "segment": pa.array(segments, pa.int32()),
            "counts": pa.array([part.tobytes() for part in counts], pa.binary()),
        }
    )


def prefix_length(n: int, percent: int) -> int:
    """A similar set has at least ``percent`` of these shingles; so it has one of the
    first ones that are left when all but one of those are set aside."""
    return n + (-percent * n) // 100 + 1


_PREFIX = np.dtype([("gram", "u8"), ("k", "i8"), ("n", "i4"), ("place", "i4")])


def _lists(
    keyed: DataFrame, texts: DataFrame, size: int, percent: int, shared: frozenset[int]
) -> DataFrame:
    """``gram, k, n, place``: classes by prefix shingle, of shingles that two or more
    have. Prefixes travel as packed arrays, one of each class from each task, and single
    ones end where they arrive."""
    spark = keyed.sparkSession
    frequency = spark.sparkContext.broadcast(_frequencies(keyed, size))
    # Copies in different tasks each send their prefix, so parts are sized by texts.
    total = texts.agg(F.sum(F.col("n") * F.lit((100 - percent) / 100) + 1)).first()[0] or 0
    parts = int(total // PREFIX_ROWS) + 1
    bits = KEY_BITS

    def named(grams: np.ndarray) -> int:
        k = _key(grams, bits)
        return _second_key(grams) if k in shared else k

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _prefixes(batches, frequency.value, parts, size, percent, named)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            np.frombuffer(x.as_py(), dtype=_PREFIX)
            for batch in batches
            for x in batch.column("entries")
        ]
        if not held:
            return
        entries = np.concatenate(held)
        del held
        entries = entries[np.lexsort((entries["k"], entries["gram"]))]
        again = (entries["gram"][1:] == entries["gram"][:-1]) & (
            entries["k"][1:] == entries["k"][:-1]
        )
        entries = entries[np.concatenate(([True], ~again))]
        alike = np.concatenate(([False], entries["gram"][1:] == entries["gram"][:-1], [False]))
        entries = entries[alike[1:] | alike[:-1]]
        yield pa.RecordBatch.from_pydict(
            {
                "gram": pa.array(entries["gram"].view(np.int64)),
                "k": pa.array(entries["k"]),
                "n": pa.array(entries["n"]),
                "place": pa.array(entries["place"]),
            }
        )

    return (
        keyed.select("text")
        .mapInArrow(emit, "part int, entries binary")
        .repartitionById(parts, F.col("part"))
        .mapInArrow(gather, "gram bigint, k bigint, n int, place int")
    )


def _prefixes(
    batches: Iterator[pa.RecordBatch],
    frequency: np.ndarray,
    parts: int,
    size: int,
    percent: int,
    named: Callable[[np.ndarray], int] = lambda grams: _key(grams, KEY_BITS),
) -> Iterator[pa.RecordBatch]:
    """The prefixes of a task's classes, each once however many texts have it; ``named``
    gives a class its key."""
    held, rows, seen = [], 0, set()
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            for _, grams in shingle_sets(chunk, size):
                if not len(grams):
                    continue
                n, k = len(grams), named(grams)
                if k in seen:
                    continue
                seen.add(k)
                order = np.lexsort((grams, frequency[_slot(grams)]))
                first = grams[order[: prefix_length(n, percent)]]
                entries = np.empty(len(first), dtype=_PREFIX)
                entries["gram"], entries["k"], entries["n"] = first, k, n
                entries["place"] = np.arange(len(first))
                held.append(entries)
                rows += len(first)
            if rows >= PREFIX_ROWS:
                yield _by_part(np.concatenate(held), parts)
                held, rows = [], 0
    if held:
        yield _by_part(np.concatenate(held), parts)


def _by_part(entries: np.ndarray, parts: int) -> pa.RecordBatch:
    part = (mix(entries["gram"]) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, entries = part[order], entries[order]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    ends = np.append(starts[1:], len(part))
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array(part[starts]),
            "entries": pa.array(
                [entries[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()
            ),
        }
    )


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _neighbours(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that follow each other, by length, in the list of a prefix shingle and pass
    the filters: ``k, unit, role, ys`` (see ``_verified``), with one partner each."""
    blocks = F.ceil(F.count(F.lit(1)).cast("double") / BLOCK)
    sizes = lists.groupBy("gram").agg(blocks.cast("int").alias("blocks"))
    # A hot list is cut by length, and within a length by class.
    cut = F.pmod(F.xxhash64("n", F.col("k") % 16), F.col("blocks"))
    placed = (
        lists.join(sizes, "gram")
        .select("gram", F.when(F.col("blocks") > 1, cut).otherwise(0).alias("cut"), "n", "k")
        .repartition("gram", "cut")
        .sortWithinPartitions("gram", "cut", "n", "k")
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            gram = batch.column("gram").to_numpy(zero_copy_only=False)
            piece = batch.column("cut").to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            k = batch.column("k").to_numpy(zero_copy_only=False)
            if before is not None:
                gram, piece, n, k = (
                    np.concatenate(([last], now))
                    for last, now in zip(before, (gram, piece, n, k))
                )
            if not len(gram):
                continue
            near = (
                (gram[1:] == gram[:-1])
                & (piece[1:] == piece[:-1])
                & (n[1:].astype(np.int64) * percent <= n[:-1].astype(np.int64) * 100)
            )
            pairs = np.unique(
                np.sort(np.stack([k[:-1][near], k[1:][near]], 1), axis=1), axis=0
            )
            before = gram[-1], piece[-1], n[-1], k[-1]
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(pairs[:, 0]), "y": pa.array(pairs[:, 1])}
            )

    pairs = placed.mapInArrow(follow, "x bigint, y bigint").distinct()
    known = classes.select("k", "n", "parts")
    both = pairs.join(known.withColumnsRenamed({"k": "x", "n": "n_x", "parts": "p_x"}), "x").join(
        known.withColumnsRenamed({"k": "y", "n": "n_y", "parts": "p_y"}), "y"
    )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_x", "n_y"))
            room = _room(_matrix(batch.column("p_x")), _matrix(batch.column("p_y")))
            keep = pa.array((100 + percent) * room >= percent * n.astype(np.int64))
            yield batch.select(["x", "y"]).filter(keep)

    passed = both.select("x", "y", "n_x", "n_y", "p_x", "p_y").mapInArrow(
        bound, "x bigint, y bigint"
    )
    to_compare = passed.select(
        F.col("x").alias("k"), F.col("y").alias("unit"), F.lit(1).alias("role"), F.array("y").alias("ys")
    )
    nobody = F.array().cast("array<bigint>").alias("ys")
    members = passed.select(
        F.col("y").alias("k"), F.col("y").alias("unit"), F.lit(0).alias("role"), nobody
    )
    return to_compare.unionByName(members.distinct())


def _matrix(parts: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in parts)
    return np.frombuffer(joined, dtype=np.uint16).reshape(-1, SLOTS)


def _room(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most shingles that sets with these parts can share; more than any set has
    where neither is counted."""
    room = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    return np.where(room == SLOTS * FULL, np.int64(1) << 32, room)


def _between_groups(
    lists: DataFrame, classes: DataFrame, groups: DataFrame, percent: int
) -> DataFrame:
    """All pairs of classes in different groups that pass the filters: ``k, unit, role,
    ys`` (see ``_verified``), where a unit is a block of classes of one group."""
    group_sizes = groups.groupBy(F.col("root").alias("r")).agg(
        F.ceil(F.count(F.lit(1)).cast("double") / UNIT).cast("int").alias("group_blocks")
    )
    sized = groups.join(group_sizes, groups["root"] == group_sizes["r"])
    known = classes.join(sized, classes["k"] == sized["node"], "left").select(
        "k",
        "parts",
        F.coalesce("root", "k").alias("root"),
        F.coalesce("group_blocks", F.lit(1)).alias("group_blocks"),
    )
    # A shingle whose classes are in one group already has nothing to add; the parts are
    # sent only to the lists of the others.
    rooted = lists.join(known.select("k", "root"), "k")
    unsettled = (
        rooted.groupBy("gram")
        .agg(
            (F.min("root") != F.max("root")).alias("open"),
            F.ceil(F.count(F.lit(1)).cast("double") / BLOCK).cast("int").alias("blocks"),
        )
        .filter("open")
        .select("gram", "blocks")
    )
    placed = (
        lists.join(stored(unsettled, "unsettled"), "gram")
        .join(known, "k")
        .withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "gram",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "k",
            "n",
            "place",
            "root",
            "group_blocks",
            "parts",
        )
        .repartition("gram", "i", "j")
        .sortWithinPartitions("gram", "i", "j")
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], set[int]] = {}
        size = 0
        for group in _groups(batches):
            compare = _pairs_of_two if isinstance(group, pa.RecordBatch) else _cross
            for x, y, unit in zip(*compare(group, percent)):
                partners = found.setdefault((x, unit), set())
                size += y not in partners
                partners.add(y)
            if size >= 200_000:
                yield _candidate_batch(found)
                found, size = {}, 0
        yield _candidate_batch(found)

    return (
        placed.mapInArrow(pairs, "k bigint, unit bigint, role int, ys array<bigint>")
        .groupBy("k", "unit", "role")
        .agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table | pa.RecordBatch]:
    """The rows of each pair of blocks of a list, which come one after the other. Lists
    of two, which are most, come many at a time as one batch, two rows for each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack(
            [batch.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "i", "j")], 1
        )
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = np.concatenate(([0], cuts, [batch.num_rows]))
        sizes = np.diff(edges)
        # The first and last may go on in other batches.
        two = np.flatnonzero(sizes[1:-1] == 2) + 1
        if len(two):
            rows = (edges[two][:, None] + np.arange(2)).ravel()
            yield batch.take(pa.array(rows))
        for at in sorted({0, len(sizes) - 1, *np.flatnonzero(sizes != 2).tolist()}):
            piece = batch.slice(int(edges[at]), int(sizes[at]))
            if held and (at > 0 or _key_of(held[-1]) != _key_of(piece)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def _key_of(piece: pa.RecordBatch) -> tuple:
    return tuple(piece.column(c)[0].as_py() for c in ("gram", "i", "j"))


def _pairs_of_two(rows: pa.RecordBatch, percent: int) -> tuple[list, list, list]:
    """What ``_cross`` gives for many lists of two."""
    column = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
    k, n, place, root = (column(c).reshape(-1, 2) for c in ("k", "n", "place", "root"))
    n, place, blocks = n.astype(np.int64), place.astype(np.int64), column("group_blocks")
    own = column("own").reshape(-1, 2)
    i, j = column("i")[::2], column("j")[::2]
    keep = (root[:, 0] != root[:, 1]) & ((i == j) | (own[:, 0] != own[:, 1]))
    keep &= n.min(axis=1) * 100 >= n.max(axis=1) * percent
    needed = -(-percent * n.sum(axis=1) // (100 + percent))
    keep &= (n - place).min(axis=1) >= needed
    parts = _matrix(rows.column("parts")).reshape(-1, 2, SLOTS)
    keep &= _room(parts[:, 0], parts[:, 1]) >= needed
    at = np.flatnonzero(keep)
    # The second of a pair is in the group of more blocks, or of the larger number.
    blocks = blocks.reshape(-1, 2)
    larger = (blocks[at, 0] > blocks[at, 1]) | (
        (blocks[at, 0] == blocks[at, 1]) & (root[at, 0] > root[at, 1])
    )
    x, y = np.where(larger, 1, 0), np.where(larger, 0, 1)
    unit = _unit(root[at, y], k[at, y], blocks[at, y])
    return k[at, x].tolist(), k[at, y].tolist(), unit.tolist()


def _unit(root: np.ndarray, k: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """A block of a group. Two may share a number by chance, which does no more than
    make them larger."""
    block = mix(k.view(np.uint64)) % blocks.astype(np.uint64)
    return (mix(root.view(np.uint64)) ^ block).view(np.int64)


def _cross(group: pa.Table, percent: int) -> tuple[list, list, list]:
    """Pairs of a list's classes, in different groups, that pass the filters. The
    second of each pair is in the larger group, by its blocks."""
    column = lambda name: group.column(name).to_numpy()
    k, n, place, root, own = (column(c) for c in ("k", "n", "place", "root", "own"))
    n, place = n.astype(np.int64), place.astype(np.int64)
    if (root == root[0]).all():
        return [], [], []
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    parts = _matrix(group.column("parts").combine_chunks())
    order = np.lexsort((k, root, column("group_blocks")))
    xs, ys = [], []
    for at, x in enumerate(order):
        others = order[at + 1 :]
        keep = root[others] != root[x]
        if i != j:
            keep &= own[others] != own[x]
        others = others[keep]
        low, high = np.minimum(n[others], n[x]), np.maximum(n[others], n[x])
        others = others[low * 100 >= high * percent]
        needed = -(-percent * (n[others] + n[x]) // (100 + percent))
        # In the list of the first shingle that two sets share, all others come after.
        behind = np.minimum(n[others] - place[others], n[x] - place[x])
        others, needed = others[behind >= needed], needed[behind >= needed]
        if len(others):
            others = others[_room(parts[others], parts[x]) >= needed]
            xs += [int(k[x])] * len(others)
            ys.append(others)
    if not xs:
        return [], [], []
    found = np.concatenate(ys)
    unit = _unit(root[found], k[found], column("group_blocks")[found])
    return xs, k[found].tolist(), unit.tolist()


def _candidate_batch(found: dict[tuple[int, int], set[int]]) -> pa.RecordBatch:
    members: dict[int, set[int]] = {}
    for (_, unit), ys in found.items():
        members.setdefault(unit, set()).update(ys)
    rows = [(x, unit, 1, sorted(ys)) for (x, unit), ys in found.items()]
    rows += [(y, unit, 0, []) for unit, ys in members.items() for y in ys]
    return pa.RecordBatch.from_pydict(
        {
            "k": pa.array([row[0] for row in rows], pa.int64()),
            "unit": pa.array([row[1] for row in rows], pa.int64()),
            "role": pa.array([row[2] for row in rows], pa.int32()),
            "ys": pa.array([row[3] for row in rows], pa.list_(pa.int64())),
        }
    )


def _verified(
    keyed: DataFrame, classes: DataFrame, needs: DataFrame, size: int, percent: int
) -> DataFrame:
    """``a, b``: the candidate pairs that are similar enough, each compared once.

    ``needs`` says in which units a class ``k`` is needed: as a member (``role`` 0), or to
    be compared with the members ``ys`` (1). Its text goes there; sets are made where they
    meet, since texts are smaller than sets.
    """
    # Plain equality, so that texts are dealt out once for all that follows.
    id_key = F.coalesce("doc", F.lit(-(2**63))).alias("d")
    holders = classes.select("k", id_key, F.col("h").alias("t"))
    needs = stored(holders.join(needs, "k"), "needs")
    found = key_filter(needs, "t")
    texts = packed(keyed.select("doc", "h", "text"), found)
    texts = texts.select(id_key, F.col("h").alias("t"), "text").repartition("d", "t")
    # Rows may repeat a text.
    texts = texts.dropDuplicates(["d", "t"])
    return (
        texts.join(needs, ["d", "t"])
        .select("unit", "role", "k", "ys", "text")
        .repartition("unit")
        .sortWithinPartitions("unit", "role")
        .mapInArrow(lambda batches: _verify(batches, size, percent), "a bigint, b bigint")
    )


def _verify(
    batches: Iterator[pa.RecordBatch], size: int, percent: int
) -> Iterator[pa.RecordBatch]:
    unit, members = None, {}
    for batch in batches:
        linked: list[tuple[int, int]] = []
        for row in batch.to_pylist():
            if row["unit"] != unit:
                unit, members = row["unit"], {}
            text = zlib.decompress(row["text"])
            _, grams = next(shingle_sets(next(chunks(pa.array([text], pa.binary()))), size))
            if row["role"] == 0:
                members[row["k"]] = grams
                continue
            for y in row["ys"]:
                both = len(np.intersect1d(grams, members[y], assume_unique=True))
                if (100 + percent) * both >= percent * (len(grams) + len(members[y])):
                    linked.append((row["k"], y))
        yield pa.RecordBatch.from_pydict(
            {
                "a": pa.array([a for a, _ in linked], pa.int64()),
                "b": pa.array([b for _, b in linked], pa.int64()),
            }
        )
