"""Sorted runs of suffixes, front-coded, and their merge by a tree of losers that knows
common prefixes.

A run lists its strings in order, each as the length of the prefix it shares with the
one before and the rest. The merge keeps for every run's head how much it shares with
the string given out last. Of two heads the one that shares more is the smaller, no
byte is looked at; only heads that share equally much are compared, from there on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

Entry = tuple[bytes, int, object]  # a string, what it shares with the one before, payload


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that are equal before ``start``."""
    end = min(len(a), len(b))
    differing = int.from_bytes(a[start:end]) ^ int.from_bytes(b[start:end])
    return end - (differing.bit_length() + 7) // 8


def front_code(sorted_strings: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """``shared, rest`` of each string of a run."""
    before = b""
    for string in sorted_strings:
        shared = common(before, string, 0)
        yield shared, string[shared:]
        before = string


def decode_run(coded: Iterable[tuple[int, bytes, object]]) -> Iterator[Entry]:
    """The strings of a front-coded run."""
    before = b""
    for shared, rest, payload in coded:
        before = before[:shared] + rest
        yield before, shared, payload


def merge(runs: list[Iterator[Entry]]) -> Iterator[Entry]:
    """All entries of sorted runs in order; equal strings follow each other."""
    width = 1
    while width < max(len(runs), 1):
        width *= 2
    runs = runs + [iter(())] * (width - len(runs))
    heads: list[Entry | None] = [next(run, None) for run in runs]
    shared = [0] * width
    losers = [-1] * width  # by inner node; the winner of all is at 0

    def beats(a: int, b: int) -> bool:
        """Whether head ``a`` comes before head ``b``; notes what the loser shares with
        the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return True
        if x is None:
            return False
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        both = common(x[0], y[0], shared[a])
        first = x[0][both : both + 1] <= y[0][both : both + 1]
        shared[b if first else a] = both
        return first

    for leaf in range(width):
        # Play up to the first node without an opponent yet, and wait there.
        winner, node = leaf, (leaf + width) // 2
        while node and losers[node] != -1:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2
        losers[node] = winner
    while True:
        winner = losers[0]
        head = heads[winner]
        if head is None:
            return
        yield head[0], shared[winner], head[2]
        heads[winner] = following = next(runs[winner], None)
        shared[winner] = following[1] if following else 0
        node = (winner + width) // 2
        while node:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2
        losers[0] = winner
