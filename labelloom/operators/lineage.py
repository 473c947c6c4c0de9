"""The shared folder of the cluster, and cutting lineage in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one set on the Spark context.

    With neither given, a folder in the warehouse, which a cluster shares as well.
    """
    folder = _configured_folder(spark) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_labelloom"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write an intermediate result once as a table, so that later jobs read it, not repeat it.

    Parquet in the shared folder survives lost executors, reads single columns, and tells the
    planner its size.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
