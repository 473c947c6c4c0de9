import pytest
from pyspark.sql import types as T

from labelloom.functions.labels import NAMES, label_names, with_label_names
from labelloom.operators import schemas as C


def empty(spark, ddl, **names):
    df = spark.createDataFrame([], ddl)
    for column, labels in names.items():
        df = with_label_names(df, column, labels)
    return df


@pytest.fixture
def four(spark):
    return [
        ("turns", empty(spark, "words array<string>, parts array<int>, turn int", parts=["noun", "verb"])),
        ("titles", empty(spark, "heading array<string>, topics array<int>, page int", topics=["law", "art", "sport"])),
        ("notes", empty(spark, "note string, page int")),
        ("reviews", empty(spark, "review string, stars int, page int", stars=["few", "many"])),
    ]


def test_groups(spark, four):
    assert C.group_mergeable(spark, four) == [["turns", "titles"], ["notes"], ["reviews"]]
    assert C.group_mergeable(spark, four, strict=True) == [["turns", "titles"], ["notes"], ["reviews"]]
    table = {(r.group_id, r.position, r.dataset) for r in C.merge_groups(spark, four).collect()}
    assert table == {(1, 0, "turns"), (1, 1, "titles"), (2, 0, "notes"), (3, 0, "reviews")}


def test_the_earlier_dataset_decides(spark):
    values = ("values", empty(spark, "a string, b int"))
    labelled = ("labelled", empty(spark, "a string, b int", b=["x"]))
    assert C.group_mergeable(spark, [values, labelled]) == [["values", "labelled"]]
    assert C.group_mergeable(spark, [labelled, values]) == [["labelled"], ["values"]]
    assert C.group_mergeable(spark, [values, labelled], strict=True) == [["values"], ["labelled"]]


def test_groups_are_not_transitive_and_may_share_members(spark):
    a = ("a", empty(spark, "p string, q int, r int", q=["x"]))
    b = ("b", empty(spark, "p array<string>, q int, r int", q=["x"]))
    c = ("c", empty(spark, "p array<string>, q int, r int", q=["x"]))
    plain = ("plain", empty(spark, "p string, q string, r int"))
    # plain needs only Value: it takes a and b and c; a (Value, ClassLabel) takes b and c.
    assert C.group_mergeable(spark, [plain, a, b, c]) == [["plain", "a", "b", "c"]]
    labels = ("labels", empty(spark, "p int, q int, r int", p=["x"], q=["y"], r=["z"]))
    # a and labels are apart; both take b.
    assert C.group_mergeable(spark, [labels, a, b]) == [["labels", "a", "b"]]
    seqs = ("seqs", empty(spark, "p array<int>, q array<int>, r array<int>"))
    assert C.group_mergeable(spark, [labels, seqs, b]) == [["labels", "b"], ["seqs", "b"]]


def test_strict_compares_types(spark):
    one, two = ("one", empty(spark, "a string, b string")), ("two", empty(spark, "a int, b string"))
    assert C.group_mergeable(spark, [one, two]) == [["one", "two"]]
    assert C.group_mergeable(spark, [one, two], strict=True) == [["one"], ["two"]]


def test_text_column(spark):
    assert C.text_column(empty(spark, "n int, parts array<string>, body string, more string")) == "body"
    assert C.text_column(empty(spark, "n int, parts array<string>")) == "parts"
    assert C.text_column(empty(spark, "n int")) is None
    df = spark.createDataFrame([(["a", "b"],)], "parts array<string>")
    assert df.select(C.text_of(df, "parts").alias("t")).first().t == "a b"


def test_cast_to_schema(spark):
    schema = T.StructType([T.StructField("label", T.IntegerType(), metadata={NAMES: ["a"]}), T.StructField("text", T.StringType())])
    df = spark.createDataFrame([("x", 0)], "text string, label long")
    cast = C.cast_to_schema(df, schema)
    assert cast.columns == ["label", "text"] and label_names(cast, "label") == ["a"]
    with pytest.raises(ValueError, match="extra"):
        C.cast_to_schema(df.selectExpr("*", "1 as more"), schema)
    with pytest.raises(ValueError, match="missing"):
        C.cast_to_schema(df.drop("label"), schema)
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        C.cast_to_schema(spark.createDataFrame([("x", 2**31)], "text string, label long"), schema).collect()


def test_concatenate_compares_types_first(spark):
    one, two = empty(spark, "a array<string>, b int"), empty(spark, "b int, a array<string>")
    assert C.concatenate([one, two]).columns == ["a", "b"]
    with pytest.raises(ValueError, match="types differ"):
        C.concatenate([one, empty(spark, "a array<int>, b int")])


def test_row_counts_include_empty_datasets(spark, four):
    assert {r.dataset: r.n_rows for r in C.row_counts([*four, ("five", spark.range(5))]).collect()} == {
        "turns": 0, "titles": 0, "notes": 0, "reviews": 0, "five": 5
    }


def test_drop_empty_text(spark):
    df = spark.createDataFrame([("",), (None,), (" ",), ("a",)], "text string")
    assert sorted(r.text for r in C.drop_empty_text(df).collect()) == [" ", "a"]
