"""Token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draw import draw


def sentence(tokens: Column) -> Column:
    """Tokens joined by a space. A null token is an error (``array_join`` would drop it)."""
    return F.when(
        F.exists(tokens, lambda t: t.isNull()), F.raise_error(F.lit("null token in a token array"))
    ).otherwise(F.array_join(tokens, " "))


def lowercase_some(tokens: Column, seed: int, row_key: Column) -> Column:
    """Lowercase each token with probability one half, fixed by ``(seed, row_key, position)``."""
    return F.transform(
        tokens, lambda t, i: F.when(draw(seed, "l", row_key, i) % 2 == 0, F.lower(t)).otherwise(t)
    )
