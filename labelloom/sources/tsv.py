"""Tab-separated sentence files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Packed bytes that one task should go on with.
BYTES_PER_TASK = 16 * 1024 * 1024


def read_tsv(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """TSV with a header and no quoting, plain or gzip; short rows end in nulls.

    A gzip file is unpacked by one task; its rows are then spread over ``partitions`` tasks, or as many as its size asks for.
    """
    if partitions is None:
        # File sizes only: no content is read.
        sizes = spark.read.format("binaryFile").load(path).where(F.col("path").endswith(".gz"))
        packed = sizes.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        partitions = -(-packed // BYTES_PER_TASK) if packed > BYTES_PER_TASK else None
    rows = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("escape", "")
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return rows.repartition(partitions) if partitions else rows
