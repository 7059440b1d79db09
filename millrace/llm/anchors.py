"""Anchors: few positions of a text, chosen by content alone, through which all repeats
of a given length can be found.

A *window* is ``window`` codes (bytes or words) long. Its anchors are the places within
it whose run of ``core`` codes has the least hash of all such runs in the window. Equal
windows have their anchors at equal places, so every repeat of a window shows as a
repeat of the cores at its anchors. Each anchor stands for the windows that start at
most ``reach = window - core`` before it; together they lie in its *context*, the
``reach`` codes before it and the ``window`` codes from it on, cut at the text's ends.

Of two anchors with equal contexts all windows are equal. What is left to compare is
anchors with equal cores and different contexts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from millrace.llm.arrays import Hashes, mix

_NONE = np.uint64(2**64 - 1)


@dataclass
class Anchors:
    """Anchors of a chunk: positions in it, and around each the codes there are."""

    at: np.ndarray
    text: np.ndarray
    left: np.ndarray
    right: np.ndarray
    core: np.ndarray
    context: np.ndarray


def find(
    hashes: Hashes, starts: np.ndarray, ends: np.ndarray, window: int, core: int
) -> Anchors:
    """Anchors of the texts ``starts[i] .. ends[i]`` of a sequence of codes."""
    reach = window - core
    n = len(hashes.sums) - 1
    cores = hashes.grams(core)
    if not len(cores):
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    # A window is none if it runs past its text.
    ends_at = np.repeat(ends, ends - starts)
    whole = np.zeros(n, dtype=bool)
    inside = np.repeat(np.arange(len(starts)), ends - starts)
    whole[: len(ends_at)] = np.arange(len(ends_at)) + window <= ends_at
    least = np.full(n, 0, dtype=np.uint64)
    lowest = _sliding(cores, reach + 1, np.minimum)
    least[: len(lowest)] = lowest
    least[~whole] = 0
    # A place is an anchor of some window that reaches it if it is the least of one.
    reached = np.concatenate((np.zeros(reach, dtype=np.uint64), least))
    greatest = _sliding(reached, reach + 1, np.maximum)[: len(cores)]
    at = np.flatnonzero((greatest == cores) & (cores != 0))
    text = inside[at]
    left = np.minimum(at - starts[text], reach)
    right = np.minimum(ends[text] - at, window)
    shape = mix((left * 65536 + right).astype(np.uint64))
    context = mix(hashes.runs(at - left, at + right) ^ shape)
    return Anchors(at, text, left, right, cores[at], context)


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Of each ``width`` values in a row, by doubling."""
    done = 1
    while done * 2 <= width:
        values = best(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return best(values[:-rest], values[rest:]) if rest else values
