"""What text pairs move and write beyond the pairs themselves."""

from __future__ import annotations

import os
import re

from labelloom.operators.text_pairs import text_pairs
from labelloom.sources.tables import write_dataset


def test_no_shuffle_moves_two_texts_of_a_pair(spark):
    rows = spark.range(60).selectExpr("id", "concat('text ', id) AS text", "id % 3 AS label")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = text_pairs(rows, "id", partners=2, pair_key="pair")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = pairs._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    inputs = re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[(.*)\]", plan)
    sides = [{c for c in re.findall(r"(\w+)#", found)} & {"a", "b", "c"} for found in inputs]
    assert {"a"} in sides
    assert max(map(len, sides)) == 1
    assert pairs.count() == pairs.select("pair").distinct().count() == 240


def test_datasets_are_written_with_zstd(spark, tmp_path):
    path = str(tmp_path / "saved")
    write_dataset(spark.range(5).selectExpr("id", "'train' AS split"), path)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
