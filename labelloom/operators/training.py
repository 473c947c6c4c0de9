"""Data side of encoder training and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import unit_score


def training_examples(pairs: DataFrame) -> DataFrame:
    """Pairs -> ``texts`` and a label that is 1.0 for ``similar`` and 0.0 for anything else."""
    others = [c for c in pairs.columns if c not in ("sentence1", "sentence2", "label")]
    return pairs.select(
        *others,
        F.array("sentence1", "sentence2").alias("texts"),
        F.coalesce(F.col("label") == "similar", F.lit(False)).cast("double").alias("label"),
    )


def scored_sentences(rows: DataFrame, split: str = "test", top: float = 5.0) -> DataFrame:
    """Rows of one split of a scored sentence file, the score rescaled to 0..1."""
    return rows.where(F.col("split") == split).select(
        "sentence1", "sentence2", unit_score(F.col("score"), top).alias("score")
    )


def distinct_sentences(pairs: DataFrame) -> DataFrame:
    """Every distinct sentence of the two columns of a pair table."""
    return pairs.select(F.explode(F.array("sentence1", "sentence2")).alias("sentence")).distinct()
