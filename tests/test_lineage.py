from pyspark.sql import functions as F

from labelloom.functions.labels import label_names, with_label_names
from labelloom.operators import lineage


def test_the_configured_folder_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert lineage.shared_folder(spark) == folder
    cut = lineage.cut_lineage(with_label_names(spark.range(5), "id", list("abcde")))
    assert label_names(cut, "id") == list("abcde")
    assert all(folder in f for f in cut.inputFiles())
    assert sorted(r.id for r in cut.collect()) == [0, 1, 2, 3, 4]


def test_the_warehouse_is_used_if_no_folder_is_set(spark, monkeypatch):
    monkeypatch.setattr(lineage, "_configured_folder", lambda _: None)
    if not spark.sparkContext.getCheckpointDir():
        assert lineage.shared_folder(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))
    assert lineage.cut_lineage(spark.range(3).withColumn("x", F.lit(1))).count() == 3


def test_scratch_paths_differ(spark):
    assert lineage.scratch_path(spark, "a") != lineage.scratch_path(spark, "a")
