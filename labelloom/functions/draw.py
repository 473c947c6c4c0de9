"""Reproducible random draws.

``rand(seed)`` follows the partitioning of the input, so the same seed gives other rows on
another cluster. These draws hash the seed with a key of the row and depend on nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(seed: int, *parts: Column | str | int) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])


def draw(seed: int, *parts: Column | str | int) -> Column:
    """Uniform integer in [0, 2**60). Strings and ints are literals, columns are read.

    60 bits, so that ``draw % n`` stays even for tables of far more than 2**32 rows.
    """
    return F.conv(F.substring(F.md5(_joined(seed, *parts)), 1, 15), 16, 10).cast("long")


def shuffle_hash(seed: int, *parts: Column | str | int) -> Column:
    """32 hex digits; sorting by it (then by the key) is a reproducible shuffle."""
    return F.md5(_joined(seed, "s", *parts))
