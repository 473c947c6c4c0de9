"""Hashed word shingles of texts, worked out for whole Arrow batches with NumPy.

A text's bytes are lower-cased (A-Z), cut into words at ASCII white space, and hashed without making
a Python object for any word: a prefix sum of byte values times powers of an odd number gives the hash of any
stretch as a difference. A shingle's hash mixes those of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Text bytes that are worked on at a time; one longer text is worked on alone.
CHUNK = 1 << 18

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20
#: Odd, with an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    found = np.ones(1, dtype=np.uint64)
    while len(found) < n:
        step = U(pow(base, len(found), 1 << 64))
        found = np.concatenate([found, found * step])
    return found[:n]


class Hasher:
    """Hashes of the words of many texts; keeps its tables between calls."""

    def __init__(self, seed: int = 0, separators: np.ndarray = SPACE):
        self.inside = ~separators
        self.values = mixed((np.arange(256, dtype=np.uint64) + U(1 + 256 * seed)) * U(0xD1342543DE82EF95))[LOWERED]
        self.seed = U(seed)
        self.up = self.down = np.zeros(0, dtype=np.uint64)
        self.sums = np.zeros(1, dtype=np.uint64)

    def spans(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte of each word of texts laid end to end, the byte behind it, and its hash."""
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = powers(BASE, n + 1), powers(pow(BASE, -1, 1 << 64), n + 1)
            self.sums = np.zeros(n + 1, dtype=np.uint64)
        word = np.take(self.inside, data, mode="clip")
        # A word begins behind white space and at the start of a text.
        before, behind = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        before[1:], behind[:-1] = word[:-1], word[1:]
        before[ends[ends < n]] = False
        behind[ends[ends > 0] - 1] = False
        first, last = np.flatnonzero(word > before), np.flatnonzero(word > behind) + 1
        sums = self.sums[: n + 1]
        np.take(self.values, data, out=sums[1:], mode="clip")
        sums[1:] *= self.up[:n]
        np.cumsum(sums[1:], out=sums[1:])
        return first, last, mixed((sums[last] - sums[first]) * self.down[first] + (last - first).astype(np.uint64))

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of texts laid end to end, and for each text the number of words up to its end."""
        first, _, hashes = self.spans(data, ends)
        return hashes, np.searchsorted(first, ends)

    def shingles(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all windows of ``size`` words."""
        n = len(hashes) - size + 1
        found = np.full(n, self.seed + U(size), dtype=np.uint64)
        for i in range(size):
            found = mixed(found * U(BASE) + hashes[i : i + n])
        return found


def text_sets(column: pa.Array, hasher: Hasher, size: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; of the whole text if it has fewer words."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        ends = offsets[at + 1 : to + 1] - offsets[at]
        hashes, upto = hasher.words(data[offsets[at] : offsets[to]], ends)
        # Windows over all texts of the chunk; those that reach into a next text are not looked at.
        windows = hasher.shingles(hashes, size) if len(hashes) >= size else np.zeros(0, np.uint64)
        begin = 0
        for end in upto:
            n = end - begin
            if n >= size:
                yield np.unique(windows[begin : end - size + 1])
            elif n:
                yield hasher.shingles(hashes[begin:end], n)
            else:
                yield np.zeros(0, np.uint64)
            begin = end
        at = to
