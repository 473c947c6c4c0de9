"""Contiguous shards of near equal bytes, cut on a global prefix sum.

Narrow rows (key, bytes, checksum) are range partitioned and sorted by key and written once. The
totals of the partitions, one small row each, give every partition its offset; with the running sum
inside its partition every row then knows the bytes before it. Cutting at equal targets is
arithmetic: a row goes to the shard that holds the middle of its bytes. No task sees more than its
range partition, and a hot key is split because the hash of the text orders it further.

Defined cases: a null text has no bytes beyond the overhead; null keys come last; rows equal in key
and text are interchangeable; an empty table gives no rows; a row longer than a shard's target
stays whole, so that shards beside it may stay empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, small, tasks

#: Bytes that a row takes besides its text.
OVERHEAD = 16


def prefix_sums(df: DataFrame, order: Sequence[Column], weight: Column) -> DataFrame:
    """``df`` with ``_weight``, and what comes before each row in order: ``_before`` and ``_rows_before``.

    ``df`` is narrow: it is shuffled, sorted and written once.
    """
    keys = [c.alias(f"_k{i}") for i, c in enumerate(order)]
    keyed = df.select("*", weight.cast("long").alias("_weight"), *keys)
    sort = [F.col(f"_k{i}").asc_nulls_last() for i in range(len(order))]
    ranged = cut(keyed.repartitionByRange(tasks(df), *sort).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(F.sum("_weight").alias("w"), F.count("*").alias("n"))
    # One row for each partition, however many rows the table has.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("_w0"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n0"),
    )
    inside = Window.partitionBy("_part").orderBy(*sort)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select(
        "*",
        F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_w1"),
        (F.row_number().over(inside) - 1).alias("_n1"),
    ).join(small(offsets, 64 * tasks(df)), "_part")
    return placed.select(
        *df.columns, "_weight", (F.col("_w0") + F.col("_w1")).alias("_before"), (F.col("_n0") + F.col("_n1")).alias("_rows_before")
    )


def shard_plan(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its ``key``, ``text_hash``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Shards are ranges of the key; slots count from 0 in the key's order.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(text).alias("text_hash"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = prefix_sums(narrow, [F.col("key"), F.col("text_hash")], F.col("size"))
    total = narrow.agg(F.sum("size").alias("total"))
    middle = (F.col("_before") * 2 + F.col("size")).cast("decimal(38,0)")
    shard = F.floor(middle * shards / (F.col("total").cast("decimal(20,0)") * 2)).cast("int")
    cutted = placed.join(small(total, 64)).withColumn("shard", F.least(shard, F.lit(shards - 1)))
    starts = cutted.groupBy("shard").agg(F.min("_rows_before").alias("_start"))
    return cutted.join(small(starts, 64 * shards), "shard").select(
        "key", "text_hash", "size", "text_crc32", "shard", (F.col("_rows_before") - F.col("_start")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the rows of ``docs`` under ``path/shard=N``, each shard in the order of its slots."""
    plan = shard_plan(docs, shards, key, text)
    # Rows equal in key and text take their slots in any order, one each.
    same = Window.partitionBy("_key", "_hash").orderBy(F.lit(0))
    spots = plan.select(
        F.col("key").alias("_key"),
        F.col("text_hash").alias("_hash"),
        "shard",
        "slot",
        F.row_number().over(Window.partitionBy("key", "text_hash").orderBy("shard", "slot")).alias("_copy"),
    )
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"))
    rows = rows.withColumn("_copy", F.row_number().over(same))
    match = F.col("r._key").eqNullSafe(F.col("s._key")) & (F.col("r._hash") == F.col("s._hash")) & (F.col("r._copy") == F.col("s._copy"))
    joined = rows.alias("r").join(spots.alias("s"), match).select("r._row", "s.shard", "s.slot")
    columns = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() != "shard"]
    ordered = joined.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select(*columns, "shard").write.partitionBy("shard").parquet(path)
