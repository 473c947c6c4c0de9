"""Expressions and small jobs that several corpus operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import scratch_path

#: Fixed: words are separated by the ASCII white space characters, and by nothing else.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: A side is broadcast only if its measured bytes stay below this.
BROADCAST_BYTES = 16 * 1024 * 1024


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate table once to the shared folder and read it from there.

    Later jobs and lost executors read the files; nothing is computed twice.
    """
    path = scratch_path(df.sparkSession, "llm")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, byte_bound: int) -> DataFrame:
    """Broadcast hint under a proven bound; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if byte_bound <= BROADCAST_BYTES else df


def bytes_of(df: DataFrame, strings: Sequence[str] = (), fixed: int = 64) -> int:
    """Bytes that the rows of a stored table take in memory, by a scan of its lengths."""
    row = F.lit(fixed)
    for c in strings:
        row = row + F.coalesce(F.octet_length(c), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0])


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df``, stored with ``_look``, a hash of the struct ``row``, and ``_number``, another for each row.

    The order by both is fixed by the rows, but for rows that are equal in all columns. Numbers are
    written before they are used, so a task that is run again does not deal them anew.
    """
    return cut(df.select("*", F.xxhash64(F.to_json(row)).alias("_look"), F.monotonically_increasing_id().alias("_number")))


def first_copies(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """The first row of each group of a ``numbered`` table, as ``_look`` and ``_number``; groups are not gathered."""
    return df.groupBy(*group).agg(F.min(F.struct("_look", "_number")).alias("_first")).select("_first.*")


def only(df: DataFrame, condition: Column, row: Column) -> DataFrame:
    """The fields of ``row`` where ``condition`` holds.

    A plain filter would be pushed down with all that its condition is made of put in place, even
    inside of lambdas, and work it out again for every use; behind a generator it is not.
    """
    found = df.select(F.explode_outer(F.when(condition, F.array(row))).alias("_only"))
    return found.where(F.col("_only").isNotNull()).select("_only.*")


def tasks(df: DataFrame) -> int:
    """Partitions for a shuffle, as the session is set."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
