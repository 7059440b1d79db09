"""Byte-level BPE by tree reduction: halves of a piece are encoded on their own, then
joined by encoding anew a window around the seam that grows until what lies outside it
provably stays.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are
the encoding of their own bytes. The tokens within a half, and those within the
window, are neighbours in an encoding already, so a join is final once the two pairs
at the window's edges pass that test. Joins are associative, hence a piece may be cut
anywhere and the tree may have any shape.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import release_memory, small_batches

RANKS = "byte_bpe_50k.tiktoken"
LEAF = 4  # bytes that are merged pair by pair, without cutting them further
# What a worker remembers, in entries; a piece and its ids take about 220 bytes, a part
# 200, a pair of tokens 160: 90 MB in all, from one task to the next.
MAX_PIECES = 220_000
MAX_PARTS = 120_000
MAX_PAIRS = 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file of lines ``base64(token) rank``."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes pieces under one table of ranks; remembers parts it has seen."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.stable: dict[tuple[int, int], bool] = {}

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece, as merging the lowest rank first gives them."""
        ids = self.parts.get(piece)
        if ids is None:
            if len(piece) <= LEAF:
                ids = self._merge(piece)
            else:
                middle = len(piece) // 2
                ids = self.join(self.encode(piece[:middle]), self.encode(piece[middle:]))
            if len(self.parts) >= MAX_PARTS:
                self.parts.clear()
            # Only short parts are met again often enough to be worth their memory.
            if len(piece) <= 8:
                self.parts[piece] = ids
        return ids

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two encodings' bytes laid end to end."""
        if not left or not right:
            return left or right
        if self._stays(left[-1], right[0]):
            return left + right
        before, after = len(left) - 1, 1
        while True:
            window = self._bytes(left[before:] + right[:after])
            ids = self._merge(window)
            left_open = before > 0 and not self._stays(left[before - 1], ids[0])
            right_open = after < len(right) and not self._stays(ids[-1], right[after])
            if not left_open and not right_open:
                return left[:before] + ids + right[after:]
            # Doubling keeps the whole join in proportion to the final window.
            size = len(left) - before + after
            before = max(0, before - size) if left_open else before
            after = min(len(right), after + size) if right_open else after

    def decode(self, ids: tuple[int, ...]) -> bytes:
        """Concatenates up the tree."""
        if len(ids) <= 1024:
            return self._bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def _bytes(self, ids: tuple[int, ...]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def _stays(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their own bytes."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= MAX_PAIRS:
                self.stable.clear()
            known = self._merge(self._bytes((a, b))) == (a, b)
            self.stable[a, b] = known
        return known

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        """Merges neighbours, lowest rank first and leftmost of equals."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 48:
            return self._merge_long(piece)
        return self._merge_short(piece)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        scores = [ranks(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            at, best = -1, None
            for i, score in enumerate(scores):
                if score is not None and (best is None or score < best):
                    at, best = i, score
            if best is None:
                return tuple(self.ranks[part] for part in parts)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = ranks(parts[at] + parts[at + 1])
            if at > 0:
                scores[at - 1] = ranks(parts[at - 1] + parts[at])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same, with the candidates in a heap: n log n instead of n squared."""
        ranks = self.ranks.get
        size = len(piece)
        ends = list(range(1, size + 1))  # of the part that starts there; 0 once merged
        before = list(range(-1, size))
        heap = []
        for i in range(size - 1):
            rank = ranks(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            rank, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= size or ends[middle] != end:
                continue  # one of the two parts has been merged meanwhile
            ends[start], ends[middle] = end, 0
            before[end] = start
            if end < size:
                rank = ranks(piece[start : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start, ends[end]))
            if start > 0:
                rank = ranks(piece[before[start] : end])
                if rank is not None:
                    heapq.heappush(heap, (rank, before[start], end))
        ids, at = [], 0
        while at < size:
            ids.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return tuple(ids)


class Pieces(dict):
    """Ids by piece of text, encoded when first asked for; those asked for last are
    remembered, in two generations."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encoder.encode(piece.encode())
        if len(piece) <= 32:
            if len(self) >= MAX_PIECES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    """Kept by a Python worker from one task to the next."""
    return Pieces(Encoder(load_ranks(path)))


def encode_texts(
    docs: DataFrame, id_column: str, text_column: str, keep_ids: bool = True
) -> DataFrame:
    """Per row of ``docs``: its id, ``n_tokens``, the SHA-256 of the ids written in
    decimal and joined by one space, and the SHA-256 of the bytes decoded from them;
    with ``keep_ids`` also ``ids`` themselves.

    A narrow transformation: rows neither move nor wait for each other. Null and empty
    texts have no tokens; repeated rows give repeated results; other columns of
    ``docs`` are not read, whatever their names. Bytes that are no UTF-8 are read as U+FFFD.
    """
    source = small_batches(docs).select(
        F.col(id_column).alias("doc"),
        F.make_valid_utf8(F.col(text_column).cast("string")).alias("text"),
    )
    kind = source.schema["doc"].dataType.simpleString()
    fields = f"doc {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    path = public_tokenizers.path(RANKS)
    done = source.mapInArrow(
        lambda batches: _encode_batches(batches, path, keep_ids),
        fields + (", ids array<int>" if keep_ids else ""),
    )
    return done.withColumnRenamed("doc", id_column)


def _encode_batches(
    batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool
) -> Iterator[pa.RecordBatch]:
    release_memory()
    pieces = _pieces(path)
    encoder = pieces.encoder
    written = {rank: str(rank) for rank in encoder.tokens}
    pattern = regex.compile(public_tokenizers.PATTERN)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            counts, ids_hashes, texts_hashes, all_ids = [], [], [], []
            for text in rows.column("text"):
                found = pattern.findall(text.as_py() or "")
                ids = list(chain.from_iterable(map(pieces.__getitem__, found)))
                counts.append(len(ids))
                spelt = " ".join(map(written.__getitem__, ids))
                ids_hashes.append(hashlib.sha256(spelt.encode()).hexdigest())
                decoded = encoder.decode(ids)
                texts_hashes.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    all_ids.append(ids)
            columns = {
                "doc": rows.column("doc"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_hashes, pa.string()),
                "decoded_sha256": pa.array(texts_hashes, pa.string()),
            }
            if keep_ids:
                columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
