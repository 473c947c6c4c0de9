"""Similarity of embedding arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(u: Column, v: Column) -> Column:
    products = F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _length(u: Column) -> Column:
    return F.sqrt(F.aggregate(u, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine(u: Column, v: Column) -> Column:
    """Cosine similarity in double precision; null if either vector has length zero.

    Each part occurs once in the expression: higher-order functions are not shared by codegen.
    """
    return F.try_divide(_dot(u, v), _length(u) * _length(v))


def unit_score(score: Column, top: float = 5.0) -> Column:
    """Rescale a 0..top score to 0..1."""
    return score.cast("double") / F.lit(top)
