"""Near-duplicate vectors by product quantisation: coarse inverted lists, codes of
residuals, table lookups, and an exact comparison of what passes.

* Vectors are compared within a label and a dimension. Equal ones are one *class*.
* A coarse quantiser (k-means) gives each vector its list, and a product quantiser codes
  what is left, subspace by subspace. Both are fitted in one task on at most about
  ``SAMPLE`` vectors, chosen by hash; every vector is indexed.
* A vector is looked up in every list whose border is near enough that a similar vector
  may lie behind it, and in the ``PROBES`` nearest in any case. Its distance to a listed
  vector's code comes from tables of its own distances to all code words, one per
  subspace. How far each code lies from its vector is known, so a pair is dropped only
  if by the triangle inequality it cannot be similar enough; all others are compared
  by cosine in double precision.

A similar vector lies at most some distance away, in a direction that has nothing to do
with the lists. Towards a list it then comes by that distance times a share with a
deviation of one over the root of the dimension; a list is looked into if its border is
within ``DEVIATIONS`` of these. That does not depend on how many lists there are, so that
recall does not fall as they grow; the tests hold it to brute force at growing sizes. A
link found from one side counts for both. Links within a piece
of work are summed up there, to a count per vector and an edge from each vector to the
least it reaches, so pairs of large groups are not listed.

Lists that are longer than ``BLOCK`` are cut into blocks, and queries that are many for a
block into shares, by hash; each is work of its own.

Defined results: vectors that are null, empty, zero, or hold null or non-finite values,
and those without label or id, link with nothing. Rows that repeat a vector are linked.
Rows that repeat an id are each compared. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import place_of, share_of, small_batches, stored

COSINE = 0.93
SAMPLE = 20_000
PROBES = 8
DEVIATIONS = 2.0
SUBSPACES = 8
CODES = 64
KEY_BITS = 64  # of a vector's key; fewer only to test what becomes of equal keys
BLOCK = 1024
SHARE = 16_384
DISTANCES = 4_000_000  # between vectors and centres, held at a time


class Quantiser:
    """Coarse centroids and code books of unit vectors of one dimension."""

    def __init__(self, sample: np.ndarray, lists: int):
        random = np.random.default_rng(5)
        self.centroids = _means(sample, min(lists, len(sample)), random)
        place = _nearest(sample, self.centroids, 1)[:, 0]
        rest = sample - self.centroids[place]
        edges = np.linspace(0, sample.shape[1], SUBSPACES + 1).astype(int)
        self.slices = [slice(a, b) for a, b in zip(edges, edges[1:]) if b > a]
        # In how many directions vectors spread within their lists.
        spread = rest.T @ rest
        size = (spread**2).sum()
        self.directions = np.trace(spread) ** 2 / size if size > 0 else sample.shape[1]
        self.books = [_means(rest[:, s], min(CODES, len(rest)), random) for s in self.slices]

    def probes(self, vectors: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The lists in which to look for what lies within ``reach`` of the vectors, each
        vector's own first, and how many they are for each vector."""
        centres = self.centroids
        squares = (centres**2).sum(axis=1)
        margin = 2 * DEVIATIONS * reach / np.sqrt(self.directions)
        found, counts = [], []
        step = max(1, DISTANCES // len(centres))
        for start in range(0, len(vectors), step):
            part = vectors[start : start + step]
            far = squares - 2 * part @ centres.T
            home = far.argmin(axis=1)
            behind = far - far[np.arange(len(part)), home][:, None]
            apart = squares + squares[home][:, None] - 2 * centres[home] @ centres.T
            # Twice the distance to the border, times that between the two centres.
            near = behind <= margin * np.sqrt(np.maximum(apart, 0))
            if PROBES < len(centres):
                least = np.argpartition(far, PROBES - 1, axis=1)[:, :PROBES]
                np.put_along_axis(near, least, True, axis=1)
            else:
                near[:] = True
            near[np.arange(len(part)), home] = False
            row, at = np.nonzero(near)
            n = np.bincount(row, minlength=len(part))
            found.append(np.insert(at, np.cumsum(n) - n, home))
            counts.append(n + 1)
        return np.concatenate(found), np.concatenate(counts)

    def encode(self, vectors: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far they are from the vectors."""
        rest = vectors - self.centroids[lists]
        codes = [_nearest(rest[:, s], book, 1)[:, 0] for s, book in zip(self.slices, self.books)]
        far = [
            ((rest[:, s] - book[code]) ** 2).sum(axis=1)
            for s, book, code in zip(self.slices, self.books, codes)
        ]
        return np.stack(codes, axis=1).astype(np.uint8), np.sqrt(sum(far))

    def distances(self, vectors: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """From each of ``vectors`` to each coded vector of list ``at``."""
        rest = vectors - self.centroids[at]
        total = np.zeros((len(vectors), len(codes)))
        for m, (s, book) in enumerate(zip(self.slices, self.books)):
            table = ((rest[:, None, s] - book[None]) ** 2).sum(axis=2)
            total += table[:, codes[:, m]]
        return np.sqrt(total)


def _nearest(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    n = min(n, len(centres))
    out = []
    for start in range(0, len(vectors), 2048):
        part = vectors[start : start + 2048]
        far = (centres**2).sum(axis=1) - 2 * part @ centres.T
        near = np.argpartition(far, n - 1, axis=1)[:, :n] if n < len(centres) else None
        if near is None:
            near = np.tile(np.arange(len(centres)), (len(part), 1))
        order = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
        out.append(np.take_along_axis(near, order, 1))
    return np.concatenate(out) if out else np.zeros((0, n), dtype=np.int64)


def _means(vectors: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    centres = vectors[random.choice(len(vectors), k, replace=False)]
    for _ in range(6):
        place = _nearest(vectors, centres, 1)[:, 0]
        counts = np.bincount(place, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, place, vectors)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def near_duplicates(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    label_column: str,
    cosine: float = COSINE,
) -> DataFrame:
    """Per row ``id, n_links, component_id``: how many other rows are linked directly,
    and the least id reachable."""
    rows = small_batches(vectors).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).cast("array<double>").alias("v"),
        F.col(label_column).cast("string").alias("label"),
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    # Comparisons of null arrays are null, and so not fine.
    fine = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("v") > 0)
        & ~F.exists("v", bad)
        & F.exists("v", lambda x: x != 0)
    )
    fine = F.coalesce(fine, F.lit(False))
    key = F.shiftrightunsigned(F.xxhash64("label", F.size("v"), "v"), 64 - KEY_BITS)
    rows = rows.select(
        "id",
        "label",
        "v",
        F.when(fine, key).alias("k"),
        F.xxhash64("v", F.lit(1), "label").alias("check"),
    )
    classes = stored(_classes(rows), "vectors")
    # Keys that different vectors share: none, or a few among many billions. Those vectors
    # go by their second hash.
    shared = [row.k for row in classes.filter("differ").select("k").collect()]
    if shared:
        key = F.when(F.col("k").isin(shared), F.col("check")).otherwise(F.col("k"))
        rows = rows.withColumn("k", key)
        classes = stored(_classes(rows), "vectors")
        again = F.when(F.col("differ"), F.raise_error(F.lit("two vectors share both hashes")))
        classes = classes.filter(again.isNull())
    classes = classes.drop("differ")
    found = stored(_links(classes, cosine), "links")
    counts = found.filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    groups = components(found.filter("b is not null"), "a", "b")
    grouped = classes.join(groups, classes["k"] == groups["node"], "left").select(
        "k", "id", "copies", F.coalesce("root", "k").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    named = (
        grouped.join(least, "root")
        .join(counts, F.col("k") == F.col("a"), "left")
        .select(
            F.col("k").alias("class"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            "component_id",
        )
    )
    linked = rows.filter("k is not null").join(named, F.col("k") == F.col("class"))
    alone = rows.filter("k is null")
    return (
        linked.select("id", "n_links", "component_id")
        .unionByName(
            alone.select(
                "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
            )
        )
        .withColumnRenamed("id", id_column)
    )


def _classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of a label as one row; ``differ`` if vectors with the same key are
    not equal."""
    return (
        rows.filter("k is not null")
        .groupBy("k")
        .agg(
            F.min("id").alias("id"),
            F.count(F.lit(1)).alias("copies"),
            F.first(F.struct("label", "v")).alias("x"),
            (F.min("check") != F.max("check")).alias("differ"),
        )
        .select("k", "id", "copies", "x.label", "x.v", "differ")
    )


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """``a, n, b``: vectors linked to ``a`` (copies counted), and edges to ``b``."""
    result = "a bigint, n bigint, b bigint"
    quantisers = _fit(classes)
    shared = classes.sparkSession.sparkContext.broadcast(pickle.dumps(quantisers))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(shared.value)
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v")])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                yield _placed(part, known[int(size)], _reach(cosine))

    placed = stored(
        classes.mapInArrow(
            place,
            "k bigint, copies bigint, label string, size int, probes array<int>, "
            "codes binary, err double, unit binary",
        ),
        "placed",
    )
    key = ["label", "size", "list"]
    entries = placed.withColumn("list", F.col("probes")[0])
    queries = placed.withColumn("list", F.explode("probes"))
    cut = lambda most, name: F.ceil(F.count("*").cast("double") / most).cast("int").alias(name)
    sizes = entries.groupBy(*key).agg(cut(BLOCK, "blocks"))
    sizes = sizes.join(queries.groupBy(*key).agg(cut(SHARE, "shares")), key)
    columns = [*key, "block", "share", "kind", "k", "copies", "probes", "codes", "err", "unit"]
    own = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entries = (
        entries.join(sizes, key)
        .withColumn("block", own("blocks"))
        .withColumn("share", every("shares"))
        .withColumn("kind", F.lit(0))
    )
    queries = (
        queries.join(sizes, key)
        .withColumn("block", every("blocks"))
        .withColumn("share", own("shares"))
        .withColumn("kind", F.lit(1))
    )
    work = (
        entries.select(*columns)
        .unionByName(queries.select(*columns))
        .repartition(*key, "block", "share")
        .sortWithinPartitions(*key, "block", "share", "kind")
    )
    return work.mapInArrow(
        lambda batches: _search(batches, pickle.loads(shared.value), cosine), result
    )


def _fit(classes: DataFrame) -> dict[int, Quantiser]:
    """A quantiser for each dimension there is, of which vectors rarely have several."""
    sizes = classes.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()
    counts = {row["size"]: row["n"] for row in sizes}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list] = {}
        for batch in batches:
            for v in batch.column("v").to_pylist():
                by_size.setdefault(len(v), []).append(v)
        made = {}
        for size, vectors in by_size.items():
            sample = _unit(np.array(sorted(vectors)))
            # Lists and their length both grow with the root of the number of vectors.
            made[size] = Quantiser(sample, int(2 * counts[size] ** 0.5) + 1)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(made)], pa.binary())})

    total = sum(counts.values())
    if not total:
        return {}
    some = classes.filter(place_of(F.col("k"), 3) < share_of(SAMPLE, total))
    # At least one of each dimension, however rare.
    each = classes.groupBy(F.size("v")).agg(F.first("v").alias("v")).select("v")
    sample = some.select("v").unionByName(each)
    rows = sample.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(rows[0]["model"])


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that the squares of very large or small values stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _reach(cosine: float) -> float:
    """How far apart unit vectors of that cosine are."""
    return float(np.sqrt(2 - 2 * cosine)) + 1e-6


def _placed(part: pa.RecordBatch, known: Quantiser, reach: float) -> pa.RecordBatch:
    vectors = _unit(np.array(part.column("v").to_pylist()))
    probes, counts = known.probes(vectors, reach)
    ends = np.concatenate(([0], np.cumsum(counts)))
    codes, err = known.encode(vectors, probes[ends[:-1]])
    return pa.RecordBatch.from_pydict(
        {
            "k": part.column("k"),
            "copies": part.column("copies"),
            "label": part.column("label"),
            "size": pa.array([vectors.shape[1]] * len(vectors), pa.int32()),
            "probes": pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(probes, pa.int32())
            ),
            "codes": pa.array([code.tobytes() for code in codes], pa.binary()),
            "err": pa.array(err),
            "unit": pa.array([vector.tobytes() for vector in vectors], pa.binary()),
        }
    )


class _Block:
    """The listed vectors of one piece of work."""

    def __init__(self, rows: list[dict]):
        self.k = np.array([row["k"] for row in rows])
        self.copies = np.array([row["copies"] for row in rows])
        self.codes = np.array([np.frombuffer(row["codes"], np.uint8) for row in rows])
        self.err = np.array([row["err"] for row in rows])
        self.unit = np.array([np.frombuffer(row["unit"]) for row in rows])
        self.probes = [set(row["probes"]) for row in rows]
        self.at = rows[0]["list"]
        self.quantiser = rows[0]["size"]


def _search(
    batches: Iterator[pa.RecordBatch], known: dict[int, Quantiser], cosine: float
) -> Iterator[pa.RecordBatch]:
    names = ("label", "size", "list", "block", "share")
    current, entries, block, queries = None, [], None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[name] for name in names)
            if key != current or len(queries) >= 512:
                if queries:
                    yield _linked(block, queries, known, cosine)
                    queries = []
            if key != current:
                current, entries, block = key, [], None
            if row["kind"] == 0:
                entries.append(row)
                continue
            block = block or (_Block(entries) if entries else None)
            if block:
                queries.append(row)
    if queries:
        yield _linked(block, queries, known, cosine)


def _linked(
    block: _Block, queries: list[dict], known: dict[int, Quantiser], cosine: float
) -> pa.RecordBatch:
    vectors = np.array([np.frombuffer(row["unit"]) for row in queries])
    k = np.array([row["k"] for row in queries])
    copies = np.array([row["copies"] for row in queries])
    home = np.array([row["probes"][0] for row in queries])
    far = known[block.quantiser].distances(vectors, block.at, block.codes)
    q, e = np.nonzero(far <= _reach(cosine) + block.err[None])
    keep = k[q] != block.k[e]
    q, e = q[keep], e[keep]
    near = (vectors[q] * block.unit[e]).sum(axis=1) >= cosine
    q, e = q[near], e[near]
    a, n, b = [], [], []
    count = np.bincount(q, block.copies[e], minlength=len(queries)).astype(np.int64)
    for i in np.flatnonzero(count):
        a.append(k[i]), n.append(count[i]), b.append(None)
    # Where the other vector does not look into this one's list, the link counts for it.
    for i, j in zip(q, e):
        if int(home[i]) not in block.probes[j]:
            a.append(block.k[j]), n.append(copies[i]), b.append(None)
    # An edge from every vector to the least one it reaches within this piece of work.
    nodes, place = np.unique(np.concatenate((k[q], block.k[e])), return_inverse=True)
    x, y = place[: len(q)], place[len(q) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[x], root[y])
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        root = root[root]
        if (root == before).all():
            break
    for i in np.flatnonzero(root != np.arange(len(nodes))):
        a.append(nodes[i]), n.append(0), b.append(nodes[root[i]])
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(a, pa.int64()), "n": pa.array(n, pa.int64()), "b": pa.array(b, pa.int64())}
    )
