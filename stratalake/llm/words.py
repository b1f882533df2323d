"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a longest run of bytes other than space and 0x09 to 0x0D. Texts are worked on in blocks
of about ``BLOCK`` bytes, whole texts each, so that memory follows the block, or the one longest
text, and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd number and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Texts ``first`` to ``first + rows - 1`` of a column: their bytes, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each run of true bytes within one text, and each text's first run."""
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            filled = self.offsets[1:] > self.offsets[:-1]
            at, last = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
            begins[at], ends[last] = inside[at], inside[last]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def hasher(self, lower: bool = False) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Gives 64-bit hashes of byte ranges by start and end: equal for equal bytes, wherever they stand."""
        data = LOWER[self.data] if lower else self.data
        up, down = _power(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        return lambda starts, ends: mix((total[ends] - total[starts]) * down[starts])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        return self.hasher(lower)(starts, ends)


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK) -> Iterator[Block]:
    """Whole texts in blocks of about ``size`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield Block(first, every[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin letters U+00C0 to U+00DE in lower case."""
    low = LOWER[data]
    second = np.flatnonzero(low[:-1] == 0xC3) + 1
    second = second[(low[second] <= 0x9E) & (low[second] >= 0x80) & (low[second] != 0x97)]
    low[second] += 0x20
    return low


class Members:
    """Finds which hashes are in a sorted array; most that aren't are ruled out by their lowest bits."""

    BITS = 20

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.near = np.zeros(1 << self.BITS, bool)
        self.near[self._low(wanted)] = True

    def _low(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are wanted, and their places in the sorted array."""
        at = np.flatnonzero(self.near[self._low(hashes)])
        place = np.searchsorted(self.wanted, hashes[at])
        place[place == len(self.wanted)] = 0
        same = self.wanted[place] == hashes[at] if len(self.wanted) else np.zeros(0, bool)
        return at[same], place[same]


def block_of(texts: list[bytes]) -> Block:
    """A block of the given texts."""
    return Block(0, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def windows(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` words, and where each text's windows begin.

    ``hashes``: of all words; ``firsts``: each text's first word. Position i holds the window that
    begins with word i; those that would leave their text are left out.
    """
    count = len(hashes)
    sizes = np.maximum(np.diff(firsts) - (n - 1), 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(firsts[:-1] - starts[:-1], sizes) + np.arange(starts[-1])
    if not len(at):
        return np.zeros(0, np.uint64), starts
    total = np.zeros(count - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : count - n + 1 + k]
    return mix(total[at]), starts
