"""Principal components of wide embeddings, without a matrix of dimension x dimension.

A few directions (a little more than the components wanted) are improved round by round: every task
multiplies its rows with the directions and back, which is its share of covariance times directions, a matrix of dimension x directions;
the shares are summed up in two levels, block of rows by block. The driver makes the sum orthogonal again (a tall, skinny QR).
Rounds end when the variances that the directions hold no longer change. What the driver and a task hold is the embeddings'
dimension times the number of directions, whatever the number of rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut_lineage
from .positions import shuffle_tasks

# What runs in tasks travels whole, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a matrix that are summed up together.
BLOCK_ROWS = 1024
SHARE = "block int, part int, share binary"


@dataclass(frozen=True)
class WideModel:
    """Directions (dimension x k, orthonormal, most variance first) and the variance along each."""

    components: np.ndarray
    variances: np.ndarray


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * width or np.isnan(flat).any():
        raise ValueError(f"embeddings must have {width} dimensions and no nulls")
    return flat.reshape(len(column), width)


def _shares(directions: Broadcast, width: int):
    """Rows -> this task's share of (sum of x x') times the directions."""
    schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("share", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = directions.value
        total = np.zeros((width, q.shape[1]))
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            total += rows.T @ (rows @ q)
        parts = [total[at : at + BLOCK_ROWS].tobytes() for at in range(0, width, BLOCK_ROWS)]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([part] * len(parts), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return read


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s.as_py()) for s in table["share"])
    return pa.table({"block": table["block"][:1], "part": table["part"][:1], "share": pa.array([total.tobytes()], pa.binary())})


def fit_wide_reducer(
    df: DataFrame, k: int, embedding: str = "embedding", extra: int = 10, rounds: int = 100, tolerance: float = 1e-12, seed: int = 7
) -> WideModel:
    """The ``k`` leading principal components of all embeddings that are not null, and their variances."""
    vectors = cut_lineage(df.select(F.col(embedding).cast("array<double>").alias("v")).where("v IS NOT NULL"))
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    if n < 2 or k > width:
        raise ValueError(f"cannot reduce {n} rows of {width or 0} dimensions to {k}")
    means = vectors.select(F.posexplode("v").alias("c", "x")).groupBy("c").agg(F.avg("x").alias("m")).collect()
    mean = np.zeros(width)
    for r in means:
        mean[r["c"]] = r["m"]
    groups = math.isqrt(shuffle_tasks(df) - 1) + 1
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, min(width, k + extra))))[0]
    before = None
    for _ in range(rounds):
        shared = df.sparkSession.sparkContext.broadcast(q)
        shares = vectors.mapInArrow(_shares(shared, width), SHARE)
        merged = shares.groupBy("block", (F.col("part") % groups).alias("group")).applyInArrow(_summed, SHARE)
        blocks = sorted((r["block"], bytes(r["share"])) for r in merged.groupBy("block").applyInArrow(_summed, SHARE).collect())
        product = np.concatenate([np.frombuffer(b).reshape(-1, q.shape[1]) for _, b in blocks])
        shared.unpersist()
        product = (product - n * np.outer(mean, mean @ q)) / (n - 1)
        # The directions' own covariance: its axes are the best components in their span.
        variances, axes = np.linalg.eigh(q.T @ product)
        order = np.argsort(-variances)[:k]
        model = WideModel(q @ axes[:, order], variances[order])
        if before is not None and np.abs(model.variances - before).max() <= tolerance * max(model.variances[0], 1e-300):
            return model
        before, q = model.variances, np.linalg.qr(product)[0]
    return model


def reduce_wide_embeddings(df: DataFrame, model: WideModel, embedding: str = "embedding", name: str = "reduced", k: int | None = None) -> DataFrame:
    """Project on the leading ``k`` components, without centring; a null embedding stays null."""
    used = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.components[:, :k]))
    width = model.components.shape[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("_v"))
            held = column.is_valid().to_numpy(zero_copy_only=False)
            found: list[np.ndarray | None] = [None] * len(column)
            for i, row in zip(np.flatnonzero(held).tolist(), _matrix(column.drop_null(), width) @ used.value):
                found[i] = row
            rest = batch.drop_columns(["_v"])
            yield rest.append_column(name, pa.array(found, pa.list_(pa.float64())))

    kept = [c for c in df.columns if c.lower() != name.lower()]
    rows = df.select(*kept, F.col(embedding).cast("array<double>").alias("_v"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_v")
    return rows.mapInArrow(read, f"{fields}, `{name}` array<double>")
