from pyspark.sql import functions as F

from labelloom.operators.label_split import is_token_tag, split_by_labels, wanted_tags


def ids(df):
    return sorted(r.id for r in df.collect())


def test_text_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, None), (3, 2), (4, 1)], "id int, label int")
    one, two = split_by_labels(df, [0, 1], [1])
    assert (ids(one), ids(two)) == ([0, 1, 4], [1, 4])
    one, two = split_by_labels(df, [None, 2], [])
    assert (ids(one), ids(two)) == ([2, 3], [])


def test_token_tags(spark):
    rows = [(0, [1, 3]), (1, [2]), (2, [4, 0]), (3, [0]), (4, []), (5, None), (6, [None, 1]), (7, [None]), (8, [1, 4, None])]
    df = spark.createDataFrame(rows, "id int, ner_tags array<int>")
    assert is_token_tag(df) and not is_token_tag(df.drop("ner_tags"))
    one, two = split_by_labels(df, [1, 2], [3, 4])
    assert (ids(one), ids(two)) == ([0, 1, 6, 8], [0, 2, 8])
    one, two = split_by_labels(df, [1, 2], [3, 4], exclusion=True)
    assert (ids(one), ids(two)) == ([1, 6], [2])
    one, two = split_by_labels(df, [None], [0])
    assert (ids(one), ids(two)) == ([6, 7, 8], [2, 3])


def test_outside_tag_is_not_special(spark):
    df = spark.createDataFrame([(0, [0, 3]), (1, [0])], "id int, ner_tags array<int>")
    one, two = split_by_labels(df, [0], [3], exclusion=True)
    assert (ids(one), ids(two)) == ([1], [])


def test_wanted_tags(spark):
    df = spark.createDataFrame([([1, 1, 2, 5],)], "ner_tags array<int>")
    assert sorted(df.select(wanted_tags(F.col("ner_tags"), [1, 5, 9])).first()[0]) == [1, 5]


def test_splits_accept_streams(spark, tmp_path):
    spark.createDataFrame([(i, [i % 4]) for i in range(20)], "id int, ner_tags array<int>").write.parquet(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("id int, ner_tags array<int>").parquet(str(tmp_path / "in"))
    one, _ = split_by_labels(stream, [1], [2])
    query = (
        one.writeStream.format("memory").queryName("split_one").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert sorted(r.id for r in spark.table("split_one").collect()) == [1, 5, 9, 13, 17]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 0, "x")], "id int, label int, text string").write.parquet(str(tmp_path / "t"))
    one, _ = split_by_labels(spark.read.parquet(str(tmp_path / "t")), [0], [1])
    plan = one.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,0)" in plan.split("PushedFilters")[1]
    assert "text" not in plan.split("ReadSchema")[1]
