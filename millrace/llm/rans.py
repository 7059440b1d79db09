"""A static range asymmetric numeral system over numpy arrays.

A *table* holds how often each symbol is expected; the frequencies are whole numbers that
add up to ``2**bits``. A block of symbols is coded by ``LANES`` interleaved states: symbol
``i`` belongs to lane ``i % LANES``, and all lanes share one stream of 32-bit words. Blocks
are independent of each other, so that many are coded side by side in one array, and any
one of them is decoded by itself.

A state is a 64-bit number of at least ``2**31``. Coding symbol ``s`` turns state ``x``
into ``(x // f << bits) + x % f + c`` (``f``: its frequency, ``c``: those of the symbols
before it), after the low word of a state that would grow too large has been sent away;
decoding takes the same steps backwards. Symbols are coded last to first, hence decoded
first to last.
"""

from __future__ import annotations

import hashlib

import numpy as np

LANES = 32
LEAST_BITS = 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class Damaged(ValueError):
    """What is read is not what was written."""


class Table:
    """Frequencies of the symbols that occur, shared by all blocks."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols = symbols.astype(np.uint32)
        self.frequencies = frequencies.astype(np.uint64)
        total = int(self.frequencies.sum())
        self.bits = max(total.bit_length() - 1, 0)
        if len(symbols) and total != 1 << self.bits:
            raise Damaged("the frequencies do not add up to a power of two")
        self.before = np.cumsum(self.frequencies, dtype=np.uint64) - self.frequencies
        # By slot and by symbol, made when first needed.
        self.symbol_of = self.place_of = None

    @classmethod
    def of_counts(cls, counts: dict[int, int]) -> "Table":
        """Every symbol that occurs gets at least 1; the rest goes by its count."""
        symbols = sorted(symbol for symbol, n in counts.items() if n > 0)
        bits = max(LEAST_BITS, len(symbols).bit_length() + 4)
        free, total = (1 << bits) - len(symbols), sum(counts[s] for s in symbols)
        frequencies = [1 + counts[s] * free // total for s in symbols]
        if symbols:
            most = max(range(len(symbols)), key=lambda i: frequencies[i])
            frequencies[most] += (1 << bits) - sum(frequencies)
        return cls(np.array(symbols, np.uint32), np.array(frequencies, np.uint64))

    def to_bytes(self) -> bytes:
        body = self.symbols.astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes()
        return hashlib.sha256(body).digest() + body

    @classmethod
    def from_bytes(cls, content: bytes) -> "Table":
        digest, body = content[:32], content[32:]
        if hashlib.sha256(body).digest() != digest or len(body) % 8:
            raise Damaged("the frequency table is not the one that was written")
        numbers = np.frombuffer(body, "<u4")
        return cls(numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :])

    @property
    def digest(self) -> bytes:
        return self.to_bytes()[:32]

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block its final states and its words."""
        if self.place_of is None:
            self.place_of = np.zeros(int(self.symbols.max(initial=0)) + 1, np.int64)
            self.place_of[self.symbols] = np.arange(len(self.symbols))
        index, active = _in_lanes([self.place_of[block] for block in blocks])
        state = np.full(index.shape[1:], _LOW, dtype=np.uint64)
        words = np.zeros(index.shape, dtype=np.uint32)
        sent = np.zeros(index.shape, dtype=bool)
        bits, room = np.uint64(self.bits), np.uint64(63 - self.bits)
        even = min(map(len, blocks), default=0) // LANES  # steps in which all lanes have one
        for step in range(len(index) - 1, -1, -1):
            here, now = index[step], active[step]
            f = self.frequencies[here]
            full = now & (state >= (f << room))
            sent[step] = full
            words[step] = state
            left = np.where(full, state >> _WORD, state)
            whole = left // f
            new = (whole << bits) + (left - whole * f) + self.before[here]
            state = new if step < even else np.where(now, new, state)
        return [(state[b].copy(), words[:, b][sent[:, b]]) for b in range(len(blocks))]

    def decode(
        self, blocks: list[tuple[np.ndarray, np.ndarray]], sizes: list[int]
    ) -> list[np.ndarray]:
        """The symbols of each block of so many."""
        if not blocks:
            return []
        if self.symbol_of is None:
            numbers = np.arange(len(self.symbols), dtype=np.uint32)
            self.symbol_of = np.repeat(numbers, self.frequencies.astype(np.int64))
        steps = -(-max(sizes) // LANES)
        whole = min(sizes) // LANES
        state = np.stack([states for states, _ in blocks]).astype(np.uint64)
        lengths = np.array([len(words) for _, words in blocks])
        ends = np.cumsum(lengths)
        at = ends - lengths
        words = np.concatenate([*(words for _, words in blocks), np.zeros(1, np.uint32)])
        words = words.astype(np.uint64)
        out = np.zeros((steps, len(blocks), LANES), dtype=np.uint32)
        lane, size = np.arange(LANES), np.array(sizes)[:, None]
        bits, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        for step in range(steps):
            slot = state & mask
            here = self.symbol_of[slot.astype(np.int64)]
            out[step] = here
            new = self.frequencies[here] * (state >> bits) + slot - self.before[here]
            low = new < _LOW
            if step >= whole:
                active = step * LANES + lane < size
                new = np.where(active, new, state)
                low &= active
            place = at[:, None] + np.cumsum(low, axis=1)
            at = place[:, -1]
            if (at > ends).any():
                raise Damaged("a block ends early")
            state = np.where(low, (new << _WORD) | words[np.where(low, place - 1, -1)], new)
        if (state != _LOW).any() or (at != ends).any():
            raise Damaged("a block does not end where it was begun")
        return [self.symbols[out[:, b].reshape(-1)[:n]] for b, n in enumerate(sizes)]


def _in_lanes(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``[step, block, lane]``, and where there is a symbol at all."""
    steps = -(-max(map(len, blocks), default=0) // LANES)
    index = np.zeros((steps, len(blocks), LANES), dtype=np.int64)
    active = np.zeros(index.shape, dtype=bool)
    for b, block in enumerate(blocks):
        padded = np.zeros(steps * LANES, dtype=np.int64)
        padded[: len(block)] = block
        index[:, b] = padded.reshape(steps, LANES)
        active[:, b] = (np.arange(steps * LANES) < len(block)).reshape(steps, LANES)
    return index, active
