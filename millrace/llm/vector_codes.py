"""Vectors as short codes: one codebook per part of the vector, fitted by Lloyd's rounds
whose nearest entries are found with adaptive bounds.

Components become integers, ``floor(1024 * x)``, and everything that decides anything is
integer arithmetic, so results do not depend on order, partitions or rounding.

What is kept of a part from one round to the next (Drake and Hamerly's bounds): its entry
with an upper bound of the distance, its ``b`` next closest entries, each with a lower
bound, and one lower bound for all entries beyond those. When the entries have moved, an
upper bound grows by how far its entry went, a lower one shrinks by how far its entry
went, the outer one by how far any went. Where the upper bound stays below all lower ones,
the part's entry is the same, and nothing is computed. Otherwise the exact distances
decide: to the own entry first, then to the ``b`` kept ones if the outer bound allows, and
only then to all. ``b`` starts at ``FIRST_BOUNDS`` and follows the parts' needs: each round
counts how many kept entries a part would have had to look at, and the next one keeps what
covers all but one in ``SPARE`` of them.

Bounds are distances in single precision, rounded away from certainty at each step: an
error of theirs can only cause a distance to be computed, never to be left out.

Each round is one pass that reads the state and writes the next one, in the shared folder,
and one that adds up the parts of each entry; per part ``ENTRIES`` sums come to the driver,
whatever the number of vectors. Rows are never moved. A state is removed once the one
after it has been written and added up.

Defined results: rows whose vector is null, empty or holds null or non-finite components
are dropped. With fewer than ``ENTRIES`` vectors a codebook has as many entries; null ids
come after all others when entries are chosen, vectors of equal ids are ordered by their
bytes. Repeated rows are coded alike and count each. An empty table gives no rows. All
vectors must have the same length, a multiple of ``PARTS``, and components below ``2**14``
in size; a job that meets others fails and says so. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import remove_stored, small_batches, stored
from millrace.sources.shared import broadcast_if_small

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
FIRST_BOUNDS = 16
LEAST_BOUNDS = 2
SPARE = 20
LARGEST = 1 << 24  # an integer component must be smaller; sums of squares then fit
_EXACT = 1 << 22  # below this, products of parts are exact as doubles
_ROWS = 4096  # parts whose distances to all entries are held at once
_STATE = "id bigint, label {label}, vector binary, bounds binary"
_UP, _DOWN = np.float32(np.inf), np.float32(-np.inf)


@dataclass
class Codebooks:
    """``entries[part]`` is an integer array of entries by components."""

    entries: np.ndarray

    def digest(self) -> str:
        numbers = ",".join(map(str, self.entries.reshape(-1).tolist()))
        return hashlib.sha256(numbers.encode()).hexdigest()


@dataclass
class Bounds:
    """Of one part of some vectors; ``near`` holds ``b`` entries, closest first."""

    entry: np.ndarray  # uint8 [n]
    upper: np.ndarray  # float32 [n]
    near: np.ndarray  # uint8 [n, b]
    lower: np.ndarray  # float32 [n, b]
    outer: np.ndarray  # float32 [n]

    @staticmethod
    def kind(b: int) -> np.dtype:
        return np.dtype(
            [("entry", "u1"), ("upper", "<f4"), ("outer", "<f4"), ("near", "u1", (b,)), ("lower", "<f4", (b,))]
        )

    def pack(self) -> np.ndarray:
        packed = np.zeros(len(self.entry), self.kind(self.near.shape[1]))
        for name in packed.dtype.names:
            packed[name] = getattr(self, name)
        return packed

    @classmethod
    def unpack(cls, packed: np.ndarray) -> "Bounds":
        return cls(*(packed[name].copy() for name in ("entry", "upper", "near", "lower", "outer")))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, ``[point, entry]``."""
    size = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if size < _EXACT and points.shape[1] <= 128:
        # All sums are whole numbers below 2**53, so doubles hold them exactly.
        p, e = points.astype(np.float64), entries.astype(np.float64)
        products = (p * p).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (p @ e.T)
        return products.astype(np.int64)
    found = np.zeros((len(points), len(entries)), dtype=np.int64)
    for k, entry in enumerate(entries):
        found[:, k] = ((points - entry) ** 2).sum(axis=1)
    return found


def _root(squares: np.ndarray, towards: np.float32) -> np.ndarray:
    """The root in single precision, never beyond the true one on the side asked for."""
    root = np.sqrt(squares).astype(np.float32)
    return np.nextafter(np.nextafter(root, towards), towards)


def full_assignment(points: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Bounds from the distances to all entries."""
    n, k = len(points), len(entries)
    b = min(b, max(k - 1, 0))
    made = Bounds(
        np.zeros(n, np.uint8), np.zeros(n, np.float32), np.zeros((n, b), np.uint8),
        np.zeros((n, b), np.float32), np.full(n, np.inf, np.float32),
    )
    for start in range(0, n, _ROWS):
        rows = slice(start, start + _ROWS)
        found = squared(points[rows], entries)
        # Of equal distances the lower index comes first.
        order = np.argsort(found, axis=1, kind="stable")[:, : b + 2]
        ranked = np.take_along_axis(found, order, axis=1)
        made.entry[rows] = order[:, 0]
        made.upper[rows] = _root(ranked[:, 0], _UP)
        made.near[rows] = order[:, 1 : b + 1]
        made.lower[rows] = _root(ranked[:, 1 : b + 1], _DOWN)
        if k > b + 1:
            made.outer[rows] = _root(ranked[:, b + 1], _DOWN)
    return made


def moved(bounds: Bounds, moves: np.ndarray) -> None:
    """Widen the bounds by how far the entries went, in place."""
    away = _root(moves.astype(np.float64) ** 2, _UP)
    bounds.upper = np.nextafter(bounds.upper + away[bounds.entry], _UP)
    bounds.lower = np.nextafter(bounds.lower - away[bounds.near], _DOWN)
    bounds.outer = np.nextafter(bounds.outer - away.max(initial=0), _DOWN)


def reassign(points: np.ndarray, entries: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Find the nearest entries again, in place. Returns for each point how many kept
    entries it needed (``b + 1``: more than there are)."""
    n, b = bounds.near.shape
    needed = np.zeros(n, dtype=np.int64)
    least = np.minimum(bounds.lower.min(axis=1, initial=np.inf), bounds.outer)
    open_ = np.flatnonzero(bounds.upper >= least)
    if not len(open_):
        return needed
    own = ((points[open_] - entries[bounds.entry[open_]]) ** 2).sum(axis=1)
    bounds.upper[open_] = _root(own, _UP)
    still = bounds.upper[open_] >= least[open_]
    open_, own = open_[still], own[still]
    within = bounds.lower[open_] <= bounds.upper[open_, None]
    needed[open_] = within.sum(axis=1)
    beyond = bounds.outer[open_] <= bounds.upper[open_]
    needed[open_[beyond]] = b + 1
    rows, own = open_[~beyond], own[~beyond]
    if len(rows):
        _among_near(points, entries, bounds, rows, own)
    rows = open_[beyond]
    if len(rows):
        made = full_assignment(points[rows], entries, b)
        for name in ("entry", "upper", "near", "lower", "outer"):
            getattr(bounds, name)[rows] = getattr(made, name)
    return needed


def _among_near(
    points: np.ndarray, entries: np.ndarray, bounds: Bounds, rows: np.ndarray, own: np.ndarray
) -> None:
    """The nearest of the own and the kept entries; all others are certainly farther."""
    for start in range(0, len(rows), _ROWS):
        part = rows[start : start + _ROWS]
        choice = np.concatenate([bounds.entry[part, None], bounds.near[part]], axis=1)
        found = np.empty(choice.shape, dtype=np.int64)
        found[:, 0] = own[start : start + _ROWS]
        for z in range(1, choice.shape[1]):
            found[:, z] = ((points[part] - entries[choice[:, z]]) ** 2).sum(axis=1)
        by_index = np.argsort(choice, axis=1)
        order = np.take_along_axis(
            by_index, np.argsort(np.take_along_axis(found, by_index, axis=1), axis=1, kind="stable"), axis=1
        )
        found = np.take_along_axis(found, order, axis=1)
        choice = np.take_along_axis(choice, order, axis=1)
        bounds.entry[part], bounds.near[part] = choice[:, 0], choice[:, 1:]
        bounds.upper[part] = _root(found[:, 0], _UP)
        bounds.lower[part] = _root(found[:, 1:], _DOWN)


def _narrowed(bounds: Bounds, b: int) -> Bounds:
    """Keep only the ``b`` entries of the least lower bounds."""
    if b >= bounds.near.shape[1]:
        return bounds
    order = np.argsort(bounds.lower, axis=1, kind="stable")
    near = np.take_along_axis(bounds.near, order, axis=1)
    lower = np.take_along_axis(bounds.lower, order, axis=1)
    outer = np.minimum(bounds.outer, lower[:, b])
    return Bounds(bounds.entry, bounds.upper, near[:, :b], lower[:, :b], outer)


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id, label, vector``: the rows that count, their components as integers of 32 bits."""
    usable = (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = (
        small_batches(vectors)
        .select(
            F.col(id_column).cast("bigint").alias("id"),
            F.col(label_column).alias("label"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        )
        .filter(usable)
    )
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            numbers = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
            if np.abs(numbers).max(initial=0) >= LARGEST:
                raise ValueError(f"a component is not below {LARGEST // SCALE} in size")
            ends = 4 * np.concatenate(([0], np.cumsum(sizes)))
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(numbers.astype("<i4"))]
            made = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), made], names=["id", "label", "vector"]
            )

    return rows.mapInArrow(run, f"id bigint, label {label}, vector binary")


def _first_codebooks(rows: DataFrame, entries: int, parts: int) -> Codebooks:
    """The parts of the vectors with the smallest ids: ``entries`` rows at most."""
    numbers = F.col("vector")
    found = (
        rows.orderBy(F.col("id").asc_nulls_last(), F.hex(numbers)).limit(entries).collect()
    )
    vectors = [np.frombuffer(row["vector"], "<i4").astype(np.int64) for row in found]
    sizes = rows.agg(F.min(F.length("vector")), F.max(F.length("vector"))).first()
    if not vectors:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    if sizes[0] != sizes[1] or len(vectors[0]) % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    return Codebooks(np.stack(vectors).reshape(len(vectors), parts, -1).swapaxes(0, 1).copy())


def _points(column: pa.Array, parts: int) -> np.ndarray:
    """``[part, vector, component]``."""
    joined = np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64)
    return joined.reshape(len(column), parts, -1).swapaxes(0, 1)


def _pass(state: DataFrame, books: Codebooks, moves: np.ndarray | None, b: int, keep: int) -> DataFrame:
    """The state after assigning all parts to ``books``: by bounds of ``b`` entries, or,
    with ``moves`` None, from scratch. ``keep`` entries are kept for the next round."""
    parts, k = books.entries.shape[:2]
    shared = state.sparkSession.sparkContext.broadcast((books.entries, moves))
    label = state.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, moves = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch.column("vector"), parts)
            n, packed, need, errors = batch.num_rows, [], [], []
            if moves is not None:
                before = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), Bounds.kind(b))
                before = before.reshape(n, parts)
            for p in range(parts):
                if moves is None:
                    bounds = full_assignment(points[p], entries[p], keep)
                    need.append(np.zeros(n, np.int64))
                else:
                    bounds = Bounds.unpack(before[:, p])
                    moved(bounds, moves[p])
                    need.append(reassign(points[p], entries[p], bounds))
                    bounds = _narrowed(bounds, keep)
                packed.append(bounds.pack())
                errors.append(((points[p] - entries[p][bounds.entry]) ** 2).sum(axis=1))
            codes = np.stack([x["entry"] for x in packed], axis=1)
            together = np.stack(packed, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("id", "label", "vector")),
                    pa.array([row.tobytes() for row in together], pa.binary()),
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(np.sum(errors, axis=0), pa.int64()),
                    pa.array([row.tobytes() for row in np.stack(need, axis=1).astype("u1")], pa.binary()),
                ],
                names=["id", "label", "vector", "bounds", "code", "error", "need"],
            )

    return state.mapInArrow(
        run, _STATE.format(label=label) + ", code binary, error bigint, need binary"
    )


def _sums(state: DataFrame, parts: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per part and entry the sum of its parts and their number; how many parts needed
    how many kept entries. Only a task's sums are shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, needs = None, np.zeros((parts, k), np.int64), np.zeros(256, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch.column("vector"), parts)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), "u1").reshape(-1, parts)
            need = np.frombuffer(b"".join(batch.column("need").to_pylist()), "u1")
            needs += np.bincount(need, minlength=256)
            if sums is None:
                sums = np.zeros((parts, k, points.shape[2]), np.int64)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                found, first = np.unique(codes[order, p], return_index=True)
                sums[p, found] += np.add.reduceat(points[p][order], first, axis=0)
                counts[p] += np.bincount(codes[:, p], minlength=k)
        if sums is None:
            return
        rows = [(p, e, -1, int(counts[p, e])) for p, e in zip(*np.nonzero(counts))]
        rows += [
            (p, e, i, x) for p, e in zip(*np.nonzero(counts)) for i, x in enumerate(sums[p, e].tolist())
        ]
        rows += [(-1, int(i), 0, int(needs[i])) for i in np.flatnonzero(needs)]
        columns = list(zip(*rows))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(v) for v in c], kind) for c, kind in zip(columns, kinds)],
            names=["part", "entry", "place", "n"],
        )

    added = state.select("vector", "code", "need").mapInArrow(
        add, "part int, entry int, place int, n bigint"
    )
    found = added.groupBy("part", "entry", "place").agg(F.sum("n").alias("n")).collect()
    width = max((row["place"] for row in found), default=-1) + 1
    sums = np.zeros((parts, k, width), np.int64)
    counts, needs = np.zeros((parts, k), np.int64), np.zeros(256, np.int64)
    for part, entry, place, n in found:
        if part < 0:
            needs[entry] = n
        elif place < 0:
            counts[part, entry] = n
        else:
            sums[part, entry, place] = n
    return sums, counts, needs


def _next_bounds(needs: np.ndarray, b: int) -> int:
    """How many entries to keep so that all but one in ``SPARE`` parts get by."""
    if needs.sum() == 0:
        return b
    covered = np.cumsum(needs) >= needs.sum() * (1 - 1 / SPARE)
    return int(min(max(np.argmax(covered), LEAST_BOUNDS), b))


def compress(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    label_column: str,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    first_bounds: int = FIRST_BOUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Each vector's ``id, label, code, error``, and the codebooks. ``code`` holds a byte
    per part, ``error`` is the sum of the parts' squared distances to their entries."""
    state = stored(whole_numbers(vectors, id_column, vector_column, label_column), "vectors")
    books = _first_codebooks(state, entries, parts)
    k = books.entries.shape[1]
    if not k:
        empty = state.select("id", "label", F.col("vector").alias("code"))
        return empty.withColumn("error", F.lit(0).cast("bigint")), books
    b = keep = min(first_bounds, k - 1)
    moves, old = None, None
    for _ in range(rounds):
        state = stored(_pass(state, books, moves, b, keep), "vector-bounds")
        b = keep
        sums, counts, needs = _sums(state, parts, k)
        if old is not None:
            remove_stored(old)
        old = state
        used = counts > 0
        new = books.entries.copy()
        new[used] = sums[used] // counts[used][:, None]  # floors, of negative sums too
        moves = np.sqrt(((new - books.entries).astype(np.float64) ** 2).sum(axis=2))
        # A little more than the distance, against the rounding of the root.
        moves = np.nextafter(moves * (1 + 1e-12), np.inf)
        books = Codebooks(new)
        keep = _next_bounds(needs, b)
    coded = _pass(state, books, moves, b, keep).select("id", "label", "code", "error")
    coded = stored(coded, "codes")
    if old is not None:
        remove_stored(old)
    return coded, books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all vectors of the label, nulls being
    one label. Errors are summed before they are moved, one row per label and task."""
    sums = stored(
        coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors"
    ).withColumnRenamed("label", "other")
    side = broadcast_if_small(sums)
    side = sums if side is None else side
    return coded.join(side, coded["label"].eqNullSafe(side["other"])).drop("other")


def hex_codes(coded: DataFrame, books: Codebooks) -> DataFrame:
    """The result in the columns of ``op13``."""
    return with_label_errors(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
