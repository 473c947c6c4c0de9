"""Texts of Arrow batches as byte arrays, in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A-Z lowered, all other bytes as they are.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def chunks(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, ends)`` of runs of texts laid end to end, about ``size`` bytes each.

    A null text is empty; one text longer than ``size`` is a run of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


def runs(inside: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each maximal run of bytes ``inside`` words, and the byte behind it; no run spans two texts."""
    n = len(inside)
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[0] = True
    fresh[ends] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    first = np.flatnonzero(inside & (fresh[:-1] | ~before))
    last = np.flatnonzero(inside & (fresh[1:] | ~after)) + 1
    return first, last


def strings(data: np.ndarray, inside: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The runs as an Arrow array of strings; ``inside`` marks exactly the bytes of the runs."""
    offsets = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(last - first, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
