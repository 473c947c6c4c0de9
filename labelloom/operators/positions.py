"""Exact row positions (0, 1, 2, ...) without a single-task sort.

``row_number()`` over one unpartitioned window sorts the whole table in one task, and over
``partitionBy(label)`` it sorts the largest label in one task. Here the keys are range partitioned,
sorted and written once, so that every task holds a stretch of the order. A position is

    rows of the group in earlier stretches  +  place in its own stretch

and what is before a stretch is a prefix sum over one row for each (group, stretch). A hot group
is spread over as many stretches as its rows need. The written keys are read from then on: lost executors and repeated reads
change nothing. There is one way for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draw import shuffle_hash
from .lineage import cut_lineage

#: Bits of a row's place that count inside its stretch.
PLACE_BITS = 33
BROADCAST_BYTES = 128 * 1024 * 1024


def small(df: DataFrame, byte_bound: int) -> DataFrame:
    """Broadcast only under a proven bound; beyond it Spark shuffles both sides."""
    return F.broadcast(df) if byte_bound <= BROADCAST_BYTES else df


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def as_columns(cols: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _stretches(df: DataFrame, order: Sequence[Column], groups: Sequence[str], unique: bool, tasks: int | None) -> DataFrame:
    """``df`` in stretches of its order, written once, with ``_at``: stretch number and place in it."""
    keys = [f"_pos_k{i}" for i in range(len(order))]
    sort = [*groups, *keys]
    keyed = df.select("*", *[c.alias(k) for k, c in zip(keys, order)])
    ranged = keyed.repartitionByRange(tasks or shuffle_tasks(df), *sort)
    if unique:
        # Equal keys are in one stretch, so this window needs no further exchange.
        again = F.row_number().over(Window.partitionBy(*sort).orderBy(keys[0])) > 1
        for k in keys:
            again = again | F.col(k).isNull()
        wrong = F.when(again, F.raise_error("keys must be unique and not null").cast("boolean")).otherwise(False)
        ranged = ranged.withColumn("_pos_wrong", wrong).where(~F.col("_pos_wrong")).drop("_pos_wrong")
    placed = ranged.sortWithinPartitions(*sort).withColumn("_pos_at", F.monotonically_increasing_id())
    return cut_lineage(placed.drop(*keys))


def with_position(
    df: DataFrame,
    order_by: str | Column | Sequence[str | Column],
    group_by: Sequence[str] = (),
    name: str = "idx",
    weight: str | None = None,
    unique: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group, in the order of ``order_by``.

    ``order_by`` sorts ascending, nulls first; equal keys take their positions in any order. With a
    ``weight`` column the position is the total weight of the rows before. With ``unique`` a null or
    repeated key in a group is an error. All columns of ``df`` are shuffled and written once, so give it the
    key columns only. ``tasks`` is the number of stretches, as many as shuffle partitions if not given.
    """
    groups = list(group_by)
    stored = _stretches(df, as_columns(order_by), groups, unique, tasks).withColumn("_pos_stretch", F.shiftright("_pos_at", PLACE_BITS))
    size = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    # One row for each group of a stretch: as many as groups and stretches at most.
    held = stored.groupBy(*groups, "_pos_stretch").agg(F.min("_pos_at").alias("_pos_first"), size.cast("long").alias("_pos_n"))
    if groups:
        earlier = Window.partitionBy(*groups).orderBy("_pos_stretch").rowsBetween(Window.unboundedPreceding, -1)
        offsets = held.withColumn("_pos_offset", F.coalesce(F.sum("_pos_n").over(earlier), F.lit(0)))
        strings = sum((F.coalesce(F.octet_length(F.col(g).cast("string")), F.lit(0)) for g in groups), F.lit(96))
        bound = held.agg(F.coalesce(F.sum(strings.cast("long")), F.lit(0))).first()[0]
    else:
        offsets, bound = _running(held)
    named = offsets.select(*[F.col(c).alias(f"_pos_o{c}") for c in [*groups, "_pos_stretch"]], "_pos_first", "_pos_offset")
    match = [F.col(c).eqNullSafe(F.col(f"_pos_o{c}")) for c in [*groups, "_pos_stretch"]]
    if weight is None:
        inside = F.col("_pos_at") - F.col("_pos_first")
    else:
        before = Window.partitionBy(*groups, "_pos_stretch").orderBy("_pos_at").rowsBetween(Window.unboundedPreceding, -1)
        stored = stored.withColumn("_pos_inside", F.coalesce(F.sum(weight).over(before), F.lit(0)).cast("long"))
        inside = F.col("_pos_inside")
    return stored.join(small(named, bound), match).select(*df.columns, (F.col("_pos_offset") + inside).alias(name))


def _running(held: DataFrame) -> tuple[DataFrame, int]:
    """Totals before each stretch, and their bytes, by the driver: there is one row for each shuffle partition."""
    found, before = [], 0
    for r in sorted(held.select("_pos_stretch", "_pos_first", "_pos_n").collect()):
        found.append((r["_pos_stretch"], r["_pos_first"], before))
        before += r["_pos_n"]
    schema = "_pos_stretch long, _pos_first long, _pos_offset long"
    return held.sparkSession.createDataFrame(found, schema), 96 * len(found)


def with_position_of_key(df: DataFrame, positions: DataFrame, keys: Sequence[str], key_bytes: int, n: int) -> DataFrame:
    """Wide rows with the positions found for their unique keys; small positions are broadcast, else both sides are shuffled."""
    return df.join(small(positions, n * (key_bytes + 24)), list(keys))


def with_position_in_runs(df: DataFrame, key: str, run: int, name: str = "idx", tasks: int | None = None) -> DataFrame:
    """Positions in the order of a unique key, with each ``run`` of consecutive rows in one partition, in order.

    Partitions follow the order: each holds a stretch of whole runs. Positions are found on the keys alone;
    the wide rows get theirs by key and then move once to where their run is.
    """
    # Written once: the filters on the wide columns are not worked out for every pass over the keys.
    keys = cut_lineage(df.select(key))
    total = keys.count()
    placed = with_position(keys, key, name=name, unique=True, tasks=tasks)
    widest = F.coalesce(F.max(F.octet_length(F.col(key).cast("string"))), F.lit(0)) + 48
    met = with_position_of_key(df, placed, [key], keys.agg(widest).first()[0], total)
    parts = tasks or shuffle_tasks(df)
    stride = max(1, -(-total // (parts * run))) * run
    spread = met.repartitionById(max(1, -(-total // stride)), (F.col(name) / stride).cast("int"))
    return spread.sortWithinPartitions(name).select(*df.columns, name)


def with_shuffled_position(df: DataFrame, key: str | Sequence[str], seed: int, name: str = "idx", tasks: int | None = None) -> DataFrame:
    """Add a position in a reproducible shuffle of the rows to a table of unique keys."""
    keys = as_columns(key)
    hashed = df.withColumn("_pos_h", shuffle_hash(seed, *keys))
    return with_position(hashed, [F.col("_pos_h"), *keys], name=name, unique=True, tasks=tasks).select(*df.columns, name)


def first_in_order(df: DataFrame, order_by: str | Column | Sequence[str | Column], n: int, tasks: int | None = None) -> DataFrame:
    """The first ``n`` rows in the order of ``order_by``, without gathering them in one task."""
    return with_position(df, order_by, name="_pos", tasks=tasks).where(F.col("_pos") < n).drop("_pos")
