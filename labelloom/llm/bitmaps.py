"""Bitmaps of hashes: prefilters whose false hits a later exact step sorts out.

A bitmap is as large as its hashes need, up to a bound, so it can be sent to every task. Where hashes outgrow the bound,
more of what has no match passes, and the exact step has more to do; no result depends on it.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
#: Least and most bits of a bitmap that is sized by its hashes, and bits for each of them.
LEAST_BITS, MOST_BITS, BITS_PER_HASH = 1 << 20, 1 << 28, 16


def fitting_bits(n: int) -> int:
    """Bits of a bitmap for ``n`` hashes: a power of two, 32 MiB at most."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_HASH * max(1, n) - 1).bit_length()))


def bitmap(hashes: DataFrame, column: str, n_bits: int = BITS) -> Broadcast:
    """A broadcast bitmap of the hashes in a long column."""
    slot = (F.pmod(column, F.lit(n_bits)) + 1).cast("long")
    rows = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    found = np.zeros(n_bits // 8, dtype=np.uint8)
    # At most 8,192 rows of 4 KiB, whatever the size of the table.
    for row in rows.toLocalIterator():
        at = (row["bucket"] - 1) * 4096
        part = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        found[at : at + len(part)] |= part
    return hashes.sparkSession.sparkContext.broadcast(found)


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash (64 bits) may be in the bitmap."""
    slot = hashes.astype(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
