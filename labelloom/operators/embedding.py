"""Dimension reduction and evaluation of sentence embeddings."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import cosine
from .lineage import cut_lineage
from .positions import with_position

HOT_SHARES = 1000


def encode(
    df: DataFrame,
    sentence: str,
    encoder: Callable[[list[str]], np.ndarray] | None = None,
    name: str = "embedding",
    factory: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    batch_size: int = 256,
) -> DataFrame:
    """Add embeddings from a user-supplied ``encoder(sentences) -> matrix``.

    A ``factory`` makes the encoder (loads the model) once in each Python worker, for all tasks that the worker runs.
    Sentences of a batch are encoded in groups of similar length, ``batch_size`` at a time, so that padding stays small.
    """
    if (encoder is None) == (factory is None):
        raise ValueError("give either an encoder or a factory")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))])
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = encoder
        if use is None:
            # What is kept beside the modules outlives a task.
            held = sys.modules.setdefault("_encoders_of_this_worker", types.ModuleType("_encoders_of_this_worker"))
            if not hasattr(held, token):
                setattr(held, token, factory())
            use = getattr(held, token)
        for batch in batches:
            texts = batch[sentence].tolist()
            order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
            found: list[np.ndarray | None] = [None] * len(texts)
            for at in range(0, len(order), batch_size):
                part = order[at : at + batch_size]
                for i, row in zip(part, np.asarray(use([texts[i] for i in part]), dtype="float32")):
                    found[i] = row
            yield batch.assign(**{name: found})

    return df.mapInPandas(run, schema)


def fit_reducer(df: DataFrame, k: int, embedding: str = "embedding") -> PCAModel:
    """Principal components of all embeddings.

    They are written once, since the fit reads them several times; the covariance is summed up by
    the tasks, and what reaches the driver is one matrix of dimension x dimension.
    """
    vectors = cut_lineage(df.select(array_to_vector(F.col(embedding).cast("array<double>")).alias("v")).where("v IS NOT NULL"))
    head = vectors.select(F.size(vector_to_array("v")).alias("d")).first()
    if head is None or k > head["d"]:
        raise ValueError(f"cannot reduce to {k} dimensions from {head['d'] if head else 'no rows'}")
    return PCA(k=k, inputCol="v", outputCol="reduced").fit(vectors)


def reduce_embeddings(
    df: DataFrame, model: PCAModel, embedding: str = "embedding", name: str = "reduced", k: int | None = None
) -> DataFrame:
    """Project on the leading ``k`` components, without centring: a dense layer without bias."""
    vectors = df.withColumn("_v", array_to_vector(F.col(embedding).cast("array<double>")))
    projected = model.setInputCol("_v").setOutputCol("_p").transform(vectors)
    reduced = vector_to_array("_p")
    return projected.select(*df.columns, (F.slice(reduced, 1, k) if k else reduced).alias(name))


def cosine_pairs(pairs: DataFrame, u: str, v: str, name: str = "cosine") -> DataFrame:
    return pairs.withColumn(name, cosine(F.col(u), F.col(v)))


def pearson(df: DataFrame, x: str | Column, y: str | Column, name: str = "pearson") -> DataFrame:
    return df.agg(F.corr(x, y).alias(name))


def spearman(df: DataFrame, x: str, y: str, name: str = "spearman", tasks: int | None = None) -> DataFrame:
    """Rank correlation with average ranks for ties.

    Ranks come from counts per distinct value, so a value that many rows share (a 0/1 gold label)
    is one counted row, never a sorted group.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    # Written once: the counted points are read for the total, for both rankings and for the sum.
    points = cut_lineage(rows.groupBy("x", "y").agg(F.count("*").alias("n")))
    total = points.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = points
    for axis in ("x", "y"):
        values = points.groupBy(axis).agg(F.sum("n").alias("_m"))
        placed = with_position(values, axis, name="_less", weight="_m", tasks=tasks)
        ranks = placed.select(
            F.col(axis).alias("_value"), "_m", (F.col("_less") + (F.col("_m") + 1) / 2).alias(f"r{axis}")
        )
        ranked = _with_ranks(ranked, ranks, axis, total)
    dx, dy = F.col("rx") - (total + 1) / 2, F.col("ry") - (total + 1) / 2
    n = F.col("n")
    return ranked.agg(
        F.try_divide(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx) * F.sum(n * dy * dy))).alias(name)
    )


def _with_ranks(points: DataFrame, ranks: DataFrame, axis: str, total: int) -> DataFrame:
    """Join points with the rank of one axis, values of many rows apart from the others.

    At most HOT_SHARES values can hold 1/HOT_SHARES of all rows each, which bounds the broadcast.
    """
    is_hot = F.col("_m") * HOT_SHARES >= F.lit(total)
    hot = F.broadcast(ranks.where(is_hot).drop("_m"))
    cold = ranks.where(~is_hot).drop("_m")
    met = points.join(hot, points[axis] == hot["_value"], "left")
    found = met.where(F.col("_value").isNotNull()).drop("_value")
    rest = met.where(F.col("_value").isNull()).drop("_value", f"r{axis}")
    return found.unionByName(rest.join(cold, rest[axis] == cold["_value"]).drop("_value"))


def cosine_loss(df: DataFrame, cos: str = "cosine", label: str = "label", name: str = "loss") -> DataFrame:
    """Mean squared difference of cosine and label."""
    return df.agg(F.avg(F.pow(F.col(cos) - F.col(label).cast("double"), 2)).alias(name))


def sweep_dimensions(
    pairs: DataFrame,
    model: PCAModel,
    dims: Sequence[int],
    u: str = "u",
    v: str = "v",
    gold: str = "gold",
) -> DataFrame:
    """``k, score``: Pearson correlation of cosine and gold after reduction to each ``k``.

    One model fitted at the largest k serves all: its leading components are the smaller models.
    All scores come from one pass over the pairs.
    """
    largest = model.getK()
    if max(dims) > largest:
        raise ValueError(f"the model has {largest} components, {max(dims)} asked for")
    both = reduce_embeddings(reduce_embeddings(pairs, model, u, "_ru"), model, v, "_rv")
    scored = running_cosines(both.select("_ru", "_rv", F.col(gold).cast("double").alias("_gold")), "_ru", "_rv", dims)
    wide = scored.agg(*[F.corr(f"_c{k}", "_gold").alias(f"k{k}") for k in dims])
    return wide.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("score")) for k in dims])).alias("s")
    ).select("s.*")


def running_cosines(df: DataFrame, u: str, v: str, dims: Sequence[int]) -> DataFrame:
    """Adds ``_c<k>``, the cosine of the leading ``k`` components, for every k of ``dims``.

    Products are summed up between one k and the next, so each component is read once for all of them.
    """
    cuts = sorted(set(dims))
    products = F.zip_with(u, v, lambda x, y: F.struct((x * y).alias("d"), (x * x).alias("a"), (y * y).alias("b")))
    zero = F.struct(*[F.lit(0.0).alias(c) for c in "dab"])

    def part(start: int, stop: int) -> Column:
        return F.aggregate(
            F.slice("_products", start + 1, stop - start), zero, lambda s, x: F.struct(*[(s[c] + x[c]).alias(c) for c in "dab"])
        )

    # One projection after the other: what is used several times is worked out once.
    parts = df.withColumn("_products", products).select(
        *df.columns, *[part(start, stop).alias(f"_to{stop}") for start, stop in zip([0, *cuts], cuts)]
    )
    sums = {k: {c: sum((F.col(f"_to{x}")[c] for x in cuts if x <= k), F.lit(0.0)) for c in "dab"} for k in cuts}
    return parts.select(
        *df.columns, *[F.try_divide(sums[k]["d"], F.sqrt(sums[k]["a"]) * F.sqrt(sums[k]["b"])).alias(f"_c{k}") for k in cuts]
    )
