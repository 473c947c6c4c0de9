"""Text files of a fixed number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import with_position, with_position_in_runs
from ..operators.schemas import drop_empty_text, text_column, text_of

LINES_PER_FILE = 500


def text_chunks(
    df: DataFrame,
    order_by: str,
    lines_per_file: int = LINES_PER_FILE,
    column: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``file_index, line, value``: non-empty texts in key order, ``lines_per_file`` to a file.

    One row is one line, also if its text holds newlines. The rows of a file are in one partition, in order.
    ``order_by`` is unique and not null.
    """
    if lines_per_file <= 0:
        raise ValueError("lines_per_file must be positive")
    column = column or text_column(df)
    if column is None:
        raise ValueError(f"no text column among {df.columns}")
    lines = drop_empty_text(df.select(F.col(order_by).alias("_key"), text_of(df, column).alias("value")), "value")
    placed = with_position_in_runs(lines, "_key", lines_per_file, "_pos", tasks)
    return placed.select(
        F.floor(F.col("_pos") / lines_per_file).cast("long").alias("file_index"),
        (F.col("_pos") % lines_per_file).cast("int").alias("line"),
        "value",
    )


def write_text_files(
    datasets: Sequence[tuple[str, DataFrame, str]],
    path: str,
    lines_per_file: int = LINES_PER_FILE,
    tasks: int | None = None,
) -> None:
    """Write ``(name, dataset, order_by)`` datasets as text files of ``lines_per_file`` rows in ``dataset=name/``.

    Each task holds a stretch of whole files in order and begins a new file after so many rows, so file names sort like
    their rows. Texts are written as they are, line feeds too, with one after each. Datasets are kept apart;
    empty files are not written.
    """
    for name, df, key in datasets:
        lines = text_chunks(df, key, lines_per_file, tasks=tasks).select("value")
        writer = lines.write.mode("errorifexists").option("maxRecordsPerFile", lines_per_file)
        writer.text(f"{path.rstrip('/')}/dataset={name}")


def read_text_files(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """``dataset, file_index, content`` of files that :func:`write_text_files` wrote."""
    where = f"{path.rstrip('/')}/dataset=*"
    # Names come from a listing that opens no file; contents are read once.
    listed = spark.read.format("binaryFile").option("basePath", path).load(where)
    names = listed.select("dataset", F.substring_index("path", "/", -1).alias("file"))
    places = with_position(names, "file", ["dataset"], "file_index", tasks=tasks)
    contents = spark.read.option("basePath", path).text(where, wholetext=True)
    named = contents.select("dataset", F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))
    return named.join(places, ["dataset", "file"]).select("dataset", "file_index", "content")
