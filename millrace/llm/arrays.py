"""Numpy helpers shared by the operators: texts of an Arrow batch as one byte array,
words as offsets into it, and position-independent hashes of any run of bytes or words.

Everything works on a *chunk*: a few megabytes of whole texts laid end to end. Nulls
are empty texts. A text longer than a chunk makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 500_000

_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 2**64)
_powers: dict[int, np.ndarray] = {}
_BYTE_CODES = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64)


@dataclass
class Chunk:
    """Texts ``first .. first + len(ends)`` of a batch, end to end in ``data``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A string or binary column as chunks of whole texts of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    buffers = column.buffers()
    wide = column.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        base = offsets[at]
        yield Chunk(
            at,
            data[base : offsets[stop]],
            offsets[at:stop] - base,
            offsets[at + 1 : stop + 1] - base,
        )
        at = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


class Hashes:
    """Hashes of runs of a sequence of codes; equal runs hash alike wherever they are."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * _power(_MULT, len(codes)), out=self.sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> "Hashes":
        return cls(_BYTE_CODES[data])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the runs ``starts[i] .. ends[i]``."""
        inverse = _power(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts])

    def grams(self, n: int) -> np.ndarray:
        """Of all runs of length ``n``."""
        if len(self.sums) <= n:
            return np.zeros(0, dtype=np.uint64)
        inverse = _power(_INVERSE, len(self.sums) - n)
        return mix((self.sums[n:] - self.sums[:-n]) * inverse)


@dataclass
class Words:
    """The words of a chunk: their byte offsets, and per text its range of words."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def of(self, chunk: Chunk, i: int) -> list[bytes]:
        data = chunk.data
        span = slice(self.first[i], self.last[i])
        return [
            data[a:b].tobytes() for a, b in zip(self.starts[span], self.ends[span])
        ]


def words(chunk: Chunk, is_word: np.ndarray) -> Words:
    """Maximal runs of bytes for which the table ``is_word`` holds, within each text."""
    inside = is_word[chunk.data]
    joined = np.zeros(len(inside) + 1, dtype=bool)
    joined[1:-1] = inside[1:] & inside[:-1]
    # A text's first byte is never joined to the text before it.
    joined[chunk.starts] = False
    joined[chunk.ends] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return Words(
        starts,
        ends,
        np.searchsorted(starts, chunk.starts, "left"),
        np.searchsorted(starts, chunk.ends, "left"),
    )


def text_of_word(found: Words) -> np.ndarray:
    """For each word the index of its text in the chunk."""
    return np.repeat(np.arange(len(found.first)), found.last - found.first)


def byte_table(pattern_out: list[tuple[int, int]]) -> np.ndarray:
    """A table that holds for all bytes outside the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in pattern_out:
        table[low : high + 1] = False
    return table


# Words split at ASCII white space, and at anything ASCII that is
# neither a digit nor a lower-case letter.
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def lowered(chunk: Chunk) -> Chunk:
    """A-Z in lower case; all other bytes, and so all offsets, stay."""
    return Chunk(chunk.first, LOWER[chunk.data], chunk.starts, chunk.ends)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte runs ``starts[i] .. ends[i]`` as a binary array."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[places])]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` positions lie in any of the intervals."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
