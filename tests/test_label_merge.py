from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.functions import labels as L
from labelloom.functions.labels import label_names, with_label_names
from labelloom.operators import label_merge as M

SCHEMA = "tokens array<string>, ner_tags array<int>, document_id int"


def dataset(spark, rows, names, schema=SCHEMA):
    return with_label_names(spark.createDataFrame(rows, schema), "ner_tags", names)


def brute_vocabulary(vocabularies):
    """Ids handed out by walking the datasets, as defined for two datasets."""
    shared = sorted(set.intersection(*map(set, vocabularies)))
    ids = {n: i for i, n in enumerate(shared)}
    for v in vocabularies:
        for n in v:
            ids.setdefault(n, len(ids))
    return [n for n, _ in sorted(ids.items(), key=lambda e: e[1])]


@pytest.mark.parametrize(
    "vocabularies",
    [
        [["O", "b", "a"], ["a", "O", "c"]],
        [["x"], ["y"]],
        [["O", "p", "q"], ["O", "q", "r"], ["O", "r", "p"]],
        [["O"]],
    ],
)
def test_merged_vocabulary(vocabularies):
    assert M.merged_vocabulary(vocabularies) == brute_vocabulary(vocabularies)


def test_merge_sorts_renumbers_and_remaps(spark):
    one = dataset(spark, [(["a"], [0, 1], 5), (["b"], [2], 1), (["c"], [], None)], ["O", "per", "loc"])
    two = dataset(spark, [(["d"], [1], 9), (["e"], [0, 2], 2)], ["loc", "O", "org"])
    for parts in (1, 4):
        for tasks in (1, 5):
            merged = M.merge_reindexed([one.repartition(parts), two.repartition(parts)], tasks=tasks)
            assert label_names(merged, "ner_tags") == ["O", "loc", "per", "org"]
            got = {(r.document_id, r.tokens[0]): list(r.ner_tags) for r in merged.collect()}
            assert got == {(0, "b"): [1], (1, "a"): [0, 2], (2, "c"): [], (3, "e"): [1, 3], (4, "d"): [0]}
    assert merged.schema["document_id"].dataType.simpleString() == "bigint"


def test_tied_and_null_ids(spark):
    rows = [([f"t{i}"], [0], [1, 1, None, None, 2][i % 5]) for i in range(30)]
    df = dataset(spark, rows, ["O", "a"])
    runs = [
        sorted((r.document_id, r.tokens[0]) for r in M.merge_reindexed([df.repartition(p)], tasks=5).collect())
        for p in (1, 3, 16)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert [i for i, _ in runs[0]] == list(range(30))
    assert {t for i, t in runs[0] if i >= 18} == {f"t{i}" for i in range(30) if i % 5 in (2, 3)}


def test_label_in_two_of_three_keeps_one_id(spark):
    sets = [dataset(spark, [(["t"], [1], k)], names) for k, names in enumerate([["O", "p"], ["O", "q"], ["O", "p"]])]
    merged = M.merge_reindexed(sets)
    assert label_names(merged, "ner_tags") == ["O", "p", "q"]
    assert [list(r.ner_tags) for r in merged.orderBy("document_id").collect()] == [[1], [2], [1]]


def test_merge_rejects_unknown_ids_and_missing_names(spark):
    with pytest.raises(Exception, match="unknown label id: 7"):
        M.merge_reindexed([dataset(spark, [(["t"], [7], 0)], ["O"])]).collect()
    with pytest.raises(ValueError, match="not a class label"):
        M.merge_reindexed([spark.createDataFrame([(["t"], [0], 0)], SCHEMA)])


def test_strict_merge(spark):
    one = dataset(spark, [(["a"], [0, 1], 5)], ["O", "per"])
    two = dataset(spark, [(["b"], [1, 0], 6)], ["loc", "O"])
    merged = M.merge_strict([one, two])
    assert label_names(merged, "ner_tags") == ["O", "loc", "per"]
    assert Counter(tuple(r.ner_tags) for r in merged.collect()) == Counter([(0, 2), (0, 1)])
    kept = M.merge_strict([one, two], keep_ids=True)
    assert Counter(tuple(r.ner_tags) for r in kept.collect()) == Counter([(0, 1), (1, 0)])
    assert label_names(kept, "ner_tags") == ["O", "loc", "per"]


def test_strict_merge_of_other_features(spark):
    one = dataset(spark, [(["a"], [0], 5)], ["O"])
    other = dataset(spark, [(["a"], [0], "5")], ["O"], "tokens array<string>, ner_tags array<int>, document_id string")
    with pytest.raises(ValueError, match="features"):
        M.merge_strict([one, other])
    reordered = dataset(spark, [(1, ["z"], [0])], ["O"], "document_id int, tokens array<string>, ner_tags array<int>")
    assert M.merge_strict([one, reordered]).count() == 2


def test_update_tags(spark):
    strings = spark.createDataFrame([(["a"], ["per", "O"], 1)], "tokens array<string>, ner_tags array<string>, document_id int")
    assert M.update_tags(strings, ["O", "per"]).first().ner_tags == [1, 0]
    with pytest.raises(Exception, match="unknown label: per"):
        M.update_tags(strings, ["O"]).collect()
    ints = spark.createDataFrame([(["a"], [3], 1)], SCHEMA)
    assert M.update_tags(ints, ["O"]).first().ner_tags == [3]


def test_label_functions(spark):
    df = dataset(spark, [([], [0], 0)], ["O", "B-a"])
    assert [(r.id, r.name) for r in L.label_map(df, "ner_tags").collect()] == [(0, "O"), (1, "B-a")]
    assert label_names(df.where("document_id = 0"), "ner_tags") == ["O", "B-a"]
    with pytest.raises(ValueError, match="unique"):
        with_label_names(df, "ner_tags", ["O", "O"])
    got = df.select(
        L.same_tag_at_same_position(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3)), 0).alias("short"),
        L.same_tag_at_same_position(F.array(F.lit(0)), F.array(F.lit(0)), 0).alias("outside"),
        L.same_tag_at_same_position(F.array(F.lit(0), F.lit(2)), F.array(F.lit(0), F.lit(2)), 0).alias("hit"),
    ).first()
    assert tuple(got) == (False, False, True)


def test_catalog_queries(spark):
    rows = spark.createDataFrame(
        [("m1", 0, "O"), ("m1", 1, "B-a"), ("m2", 0, "O"), ("m2", 1, "b"), ("m2", 2, "b")], "model string, id int, label string"
    )
    catalog = M.label_catalog(rows, "model", "label")
    assert [r.name for r in M.common_labels(catalog).collect()] == ["O"]
    assert {(r.id, r.name) for r in M.label_union(catalog).collect()} == {(0, "B-a"), (1, "O"), (2, "b")}
    assert {(r.dataset, r.is_iob) for r in M.iob_check(catalog).collect()} == {("m1", True), ("m2", False)}
    inventory = {tuple(r) for r in M.label_inventory(rows).select("label", "n_models", "n_ids", "n_labels").collect()}
    assert inventory == {("O", 2, 2, 3), ("B-a", 1, 1, 3), ("b", 1, 2, 3)}
    assert M.label_inventory(rows.limit(0)).count() == 0
    iob = rows.where("model = 'm1'").select("id", F.col("label").alias("name"))
    assert {r.iob_name for r in M.iob_names(iob).collect()} == {"O", "B-a"}
    plain = rows.where("model = 'm2' and id < 2").select("id", F.col("label").alias("name"))
    assert {r.iob_name for r in M.iob_names(plain).collect()} == {"O", "B-b"}


def test_many_copies_and_null_ids_are_counted_then_numbered(spark):
    """Groups larger than a bucket: half the rows are copies without an id."""
    rows = [(["copy"], [0], None)] * 60 + [([f"t{i}"], [0], None) for i in range(20)] + [([f"u{i}"], [1], i) for i in range(40)]
    df = dataset(spark, rows, ["O", "a"])
    small = {(r.document_id, r.tokens[0]) for r in M.merge_reindexed([df]).collect()}
    for parts in (1, 7):
        got = {(r.document_id, r.tokens[0]) for r in M.merge_reindexed([df.repartition(parts)], tasks=5).collect()}
        assert got == small
    assert sorted(i for i, _ in small) == list(range(120))
    assert {t for i, t in small if i < 40} == {f"u{i}" for i in range(40)}


def test_tiebreak_and_string_ids(spark):
    rows = [([f"t{i}"], [0], None if i % 2 else 5, i) for i in range(40)]
    df = with_label_names(
        spark.createDataFrame(rows, "tokens array<string>, ner_tags array<int>, document_id int, line int"), "ner_tags", ["O"]
    )
    for tasks in (1, 6):
        got = M.sorted_concat([df, df], "document_id", ["line"], tasks=tasks).collect()
        want = [r[0][0] for r in sorted(rows, key=lambda r: (r[2] is None, r[3]))] * 2
        assert [r.tokens[0] for r in sorted(got, key=lambda r: r.document_id)] == want
    named = spark.createDataFrame([(f"k{i:02d}", i) for i in range(30)] + [(None, 99)], "name string, v int")
    got = M.sorted_concat([named.repartition(4)], "name", tasks=5).collect()
    assert [r.v for r in sorted(got, key=lambda r: r.name)] == [*range(30), 99]


def test_lookup_in_a_large_vocabulary(spark):
    names = [f"né{i * 7919 % 50_000}" for i in range(50_000)]
    df = spark.range(50_000).select("id", F.concat(F.lit("né"), F.col("id") * 7919 % 50_000).alias("name"))
    looked = df.select("id", L.name_to_id(F.col("name"), names).alias("found"))
    assert "array_position" not in looked._jdf.queryExecution().optimizedPlan().toString()
    assert looked.where("found <> id OR found IS NULL").count() == 0
    tags = df.where("id < 100").select("id", L.names_to_ids(F.array("name", F.lit("né0")), names).alias("found"))
    assert all(r.found == [r.id, 0] for r in tags.collect())
    for wrong in ("nobody", None):
        with pytest.raises(Exception, match="unknown label"):
            spark.createDataFrame([(wrong,)], "name string").select(L.name_to_id(F.col("name"), names)).collect()
    with pytest.raises(Exception, match="unknown label"):
        spark.createDataFrame([("a",)], "name string").select(L.name_to_id(F.col("name"), [])).collect()
