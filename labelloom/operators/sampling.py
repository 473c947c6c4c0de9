"""Splits, samples and batches in a reproducible shuffle order.

Splits and samples need no shuffle of the data: the rank where a cut falls is turned into the
(hash, key) value of the row at that rank, and every row is then compared with that value where it
is read. Finding the value reads the key column a few times, so the input should be a stored table
(or one whose keys are cheap), not the result of a long job. Small samples are taken in one read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draw import shuffle_hash
from .gather import row_bytes
from .lineage import cut_lineage
from .positions import as_columns, shuffle_tasks, small, with_position, with_position_of_key, with_shuffled_position

PREFIX_DIGITS = 3  # 4,096 counters per level reach the driver
ROWS_TO_SORT = 10_000
HASH_DIGITS = 32
#: Rows of a sample that a task can hold whole.
SMALL_SAMPLE = 10_000

SPLIT_70_15_15 = {"train": 0.70, "validation": 0.15, "test": 0.15}
SPLIT_80_10_10 = {"train": 0.80, "validation": 0.10, "test": 0.10}


class _ShuffleOrder:
    """Ranks of rows in shuffle order, found by counting hash prefixes."""

    def __init__(self, df: DataFrame, key: str | Sequence[str], seed: int):
        self.keys = as_columns(key)
        self.hash = shuffle_hash(seed, *self.keys)
        self.rows = df.select(self.hash.alias("h"), *[k.alias(f"k{i}") for i, k in enumerate(self.keys)])
        self._histograms: dict[str, list[tuple[str, int]]] = {}
        if self.rows.where(reduce(or_, [F.col(f"k{i}").isNull() for i in range(len(self.keys))])).take(1):
            raise ValueError("sampling keys must not be null")
        self.total = sum(n for _, n in self._histogram(""))

    def _histogram(self, prefix: str) -> list[tuple[str, int]]:
        if prefix not in self._histograms:
            rows = self.rows.where(F.col("h").startswith(prefix)) if prefix else self.rows
            counted = rows.groupBy(F.substring("h", 1, len(prefix) + PREFIX_DIGITS).alias("p")).count()
            self._histograms[prefix] = sorted((r["p"], r["count"]) for r in counted.collect())
        return self._histograms[prefix]

    def before(self, rank: int) -> Column:
        """True for exactly the first ``rank`` rows."""
        if rank <= 0:
            return F.lit(False)
        if rank >= self.total:
            return F.lit(True)
        prefix, left = "", rank
        while True:
            for p, n in self._histogram(prefix):
                if left < n:
                    prefix = p
                    break
                left -= n
            if left == 0:
                return self.hash < F.lit(prefix)
            if n <= ROWS_TO_SORT:
                break
            if len(prefix) >= HASH_DIGITS:
                raise ValueError("sampling keys must be unique")
        around = self.rows.where(F.col("h").startswith(prefix)).orderBy(*self.rows.columns).limit(left + 1).collect()
        cut = around[-1]
        # Rows equal to the one at the cut would all fall on one side of it.
        if around[left - 1] == cut:
            raise ValueError("sampling keys must be unique")
        below = F.lit(False)
        for i, key in reversed(list(enumerate(self.keys))):
            value = F.lit(cut[f"k{i}"])
            below = (key < value) | ((key == value) & below)
        return (self.hash < cut["h"]) | ((self.hash == cut["h"]) & below)


def assign_splits(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = 42,
    fractions: dict[str, float] = SPLIT_70_15_15,
    name: str = "split",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add a split column with exact sizes.

    With n rows, ceil((validation + test) * n) are held out and ceil(test / (validation + test))
    of those are test rows. ``key`` is unique and not null. ``keys`` may give the same keys from a
    cheaper place than ``df``.
    """
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError(f"split fractions must sum to 1: {fractions}")
    test, held_share = fractions["test"], fractions["test"] + fractions["validation"]
    order = _ShuffleOrder(df if keys is None else keys, key, seed)
    held = math.ceil(held_share * order.total)
    n_test = math.ceil(test / held_share * held) if held else 0
    return df.withColumn(
        name,
        F.when(order.before(n_test), "test").when(order.before(held), "validation").otherwise("train"),
    )


def _least(df: DataFrame, key: str | Sequence[str], n: int, seed: int) -> DataFrame:
    """The ``n`` rows of least hash, from one read of ``df``, written once.

    Every task keeps its ``n`` least rows, groups of tasks merge theirs, and the last task merges those of the groups.
    """
    keys = as_columns(key)
    # Made beside the rows: the key may be a column of any name.
    named = df.select("*", shuffle_hash(seed, *keys).alias("_h"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    order = ["_h", *[f"_k{i}" for i in range(len(keys))]]
    null = reduce(or_, [F.col(k).isNull() for k in order[1:]])
    checked = named.withColumn("_h", F.when(null, F.raise_error("sampling keys must not be null")).otherwise(F.col("_h")))
    groups = math.isqrt(shuffle_tasks(df) - 1) + 1
    grouped = checked.withColumn("_group", F.spark_partition_id() % groups)
    kept = grouped.withColumn("_r", F.row_number().over(Window.partitionBy("_group").orderBy(*order))).where(F.col("_r") <= n)
    sample = cut_lineage(kept.drop("_group", "_r").orderBy(*order).limit(n))
    if sample.groupBy(*order[1:]).count().where("count > 1").take(1):
        raise ValueError("sampling keys must be unique")
    return sample.select(*df.columns)


def sample_exactly(df: DataFrame, key: str | Sequence[str], n: int = 20, seed: int = 42) -> DataFrame:
    """``n`` random rows without replacement; an error if there are fewer.

    Up to ``SMALL_SAMPLE`` rows are found in one read of ``df``; for more, keys are counted first.
    """
    if 0 < n <= SMALL_SAMPLE:
        sample = _least(df, key, n, seed)
        if (found := sample.count()) < n:
            raise ValueError(f"cannot sample {n} rows from {found}")
        return sample
    order = _ShuffleOrder(df, key, seed)
    if order.total < n:
        raise ValueError(f"cannot sample {n} rows from {order.total}")
    return df.where(order.before(n))


def sample_up_to(df: DataFrame, key: str | Sequence[str], n: int = 100_000, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of the shuffle, or all rows if there are fewer."""
    if 0 < n <= SMALL_SAMPLE:
        return _least(df, key, n, seed)
    return df.where(_ShuffleOrder(df, key, seed).before(n))


def shuffled_batches(
    df: DataFrame,
    key: str | Sequence[str],
    batch_size: int = 32,
    seed: int = 42,
    tasks: int | None = None,
) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: shuffled mini-batches, the last one possibly short.

    ``key`` names unique columns. Only keys are ranked; the rows get their place by key.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    keys = [key] if isinstance(key, str) else list(key)
    positions = with_shuffled_position(df.select(*keys), keys, seed, "_pos", tasks)
    placed = with_position_of_key(df, positions, keys, *_key_size(df, keys))
    return placed.select(
        *df.columns,
        F.floor(F.col("_pos") / batch_size).cast("long").alias("batch_id"),
        F.pmod(F.col("_pos"), F.lit(batch_size)).cast("int").alias("batch_pos"),
    )


def flag_every_kth(
    df: DataFrame,
    order_by: str | Sequence[str],
    k: int,
    group_by: Sequence[str] = (),
    name: str = "flagged",
    tasks: int | None = None,
) -> DataFrame:
    """Flag rows 0, k, 2k, ... of each group.

    ``order_by`` names columns that are unique in a group. Only keys are ranked, and the one in k that is
    flagged is joined back.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    keys, groups = [order_by] if isinstance(order_by, str) else list(order_by), list(group_by)
    placed = with_position(df.select(*groups, *keys), keys, groups, "_pos", unique=True, tasks=tasks)
    chosen = placed.where(F.col("_pos") % k == 0).select(*[F.col(c).alias(f"_f{c}") for c in (*groups, *keys)], F.lit(True).alias("_hit"))
    match = [F.col(c).eqNullSafe(F.col(f"_f{c}")) for c in (*groups, *keys)]
    key_bytes, n = _key_size(df, [*groups, *keys])
    met = df.join(small(chosen, -(-n // k) * (key_bytes + 24)), match, "left")
    return met.select(*df.columns, F.coalesce("_hit", F.lit(False)).alias(name))


def _key_size(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Bytes that a key takes at most, and rows."""
    return tuple(df.agg(row_bytes(df, keys), F.count("*")).first())
