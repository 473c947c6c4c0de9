"""Datasets on disk: parquet directories partitioned by split."""

from __future__ import annotations

import itertools
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = "split"
# What the info says if nothing is given.
UNDESCRIBED, UNCITED = "No description provided", "No citation provided"


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A saved dataset with its ``split`` column; failures name the path."""
    try:
        df = spark.read.parquet(path)
    except PySparkException as e:
        raise OSError(f"{path} holds no dataset that can be read") from e
    return df.withColumn(SPLIT, F.col(SPLIT).cast("string")) if SPLIT in df.columns else df


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; other partitions are not listed into the scan."""
    return read_dataset(spark, path).where(F.col(SPLIT) == split).drop(SPLIT)


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Save a dataset, one directory per split."""
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(SPLIT) if SPLIT in df.columns else writer).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The file system that ``path`` is on, and how to make a path for it."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def claim_version(spark: SparkSession, parent: str, name: str) -> tuple[str, str]:
    """The path of the lowest version of ``name`` that nobody has or writes, and the marker file that claims it.

    The marker is created exclusively, so of two writers one gets the next number. Versions that were
    claimed but never written keep their number.
    """
    fs, make = _file_system(spark, parent)
    home = make(parent)
    fs.mkdirs(home)
    there = {status.getPath().getName() for status in fs.listStatus(home)}
    for number in itertools.count(1):
        version, marker = f"{name}_{number}", f"_{name}_{number}.claim"
        if version in there or marker in there:
            continue
        try:
            fs.create(make(home, marker), False).close()
        except Py4JJavaError as e:
            if not fs.exists(make(home, marker)):
                raise OSError(f"cannot write to {parent}") from e
            continue
        return f"{parent.rstrip('/')}/{version}", f"{parent.rstrip('/')}/{marker}"


def dataset_info(description: str, citation: str) -> dict:
    """Info stored next to a merged dataset (fixed values but for the two texts)."""
    return {
        "description": description,
        "citation": citation,
        "builder_name": "custom_dataset_merge",
        "config_name": "default",
        "version": {"version_str": "0.0.0", "major": 0, "minor": 0, "patch": 0},
    }


def write_info(spark: SparkSession, info: dict, path: str) -> None:
    """One JSON line in ``path/_info``; readers of the table skip names starting with ``_``."""
    spark.range(1).select(F.lit(json.dumps(info)).alias("value")).coalesce(1).write.mode("errorifexists").text(
        f"{path.rstrip('/')}/_info"
    )


def read_info(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path.rstrip('/')}/_info").first()["value"])


def write_versioned(
    df: DataFrame,
    parent: str,
    name: str = "merged_dataset",
    description: str = UNDESCRIBED,
    citation: str = UNCITED,
) -> str:
    """Save under the next free version of ``name`` with its info; returns the path.

    Data and info are written aside and get their name together, so there is no version without info.
    """
    spark = df.sparkSession
    path, marker = claim_version(spark, parent, name)
    fs, make = _file_system(spark, parent)
    aside = f"{parent.rstrip('/')}/_{uuid.uuid4().hex}"
    write_dataset(df, aside)
    write_info(spark, dataset_info(description, citation), aside)
    if fs.exists(make(path)) or not fs.rename(make(aside), make(path)):
        raise OSError(f"{path} is taken; the data are in {aside}")
    fs.delete(make(marker), False)
    return path
