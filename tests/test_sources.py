import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labelloom.functions.labels import label_names, with_label_names
from labelloom.operators.training import distinct_sentences, scored_sentences, training_examples
from labelloom.plans import jobs
from labelloom.sources import tables, text_files, tsv


def test_dataset_round_trip(spark, tmp_path):
    path = str(tmp_path / "d")
    df = with_label_names(
        spark.createDataFrame([(1, 0, "train"), (2, 1, "test"), (3, 1, "7")], "id int, label int, split string"),
        "label",
        ["a", "b"],
    )
    tables.write_dataset(df, path)
    back = tables.read_dataset(spark, path)
    assert {tuple(r) for r in back.select("id", "label", "split").collect()} == {(1, 0, "train"), (2, 1, "test"), (3, 1, "7")}
    assert label_names(back, "label") == ["a", "b"]
    one = tables.read_split(spark, path, "test")
    assert [tuple(r) for r in one.collect()] == [(2, 1)]
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_dataset(df, path)


def test_missing_dataset_names_the_path(spark, tmp_path):
    with pytest.raises(OSError, match="nowhere"):
        tables.read_dataset(spark, str(tmp_path / "nowhere"))


def test_versions_and_info(spark, tmp_path):
    df = spark.createDataFrame([(1, "train")], "id int, split string")
    paths = [tables.write_versioned(df, str(tmp_path), description=f"d{i}", citation="c") for i in range(3)]
    assert [p.rsplit("/", 1)[1] for p in paths] == ["merged_dataset_1", "merged_dataset_2", "merged_dataset_3"]
    info = tables.read_info(spark, paths[1])
    assert (info["description"], info["citation"], info["version"]["version_str"]) == ("d1", "c", "0.0.0")
    assert tables.read_dataset(spark, paths[1]).columns == ["id", "split"]


def test_two_writers_get_two_versions(spark, tmp_path):
    df = spark.range(3)
    path, marker = tables.claim_version(spark, str(tmp_path), "set")
    other, _ = tables.claim_version(spark, str(tmp_path), "set")
    assert [p.rsplit("/", 1)[1] for p in (path, other)] == ["set_1", "set_2"]
    # Claimed by others, not written: the next writer leaves them alone.
    assert tables.write_versioned(df, str(tmp_path), "set").endswith("set_3")
    Path(marker).unlink()
    assert tables.write_versioned(df, str(tmp_path), "set").endswith("set_1")
    assert tables.write_versioned(df, str(tmp_path), "other").endswith("other_1")


def test_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def write(i):
        return tables.write_versioned(spark.range(i + 1), str(tmp_path), "set", f"d{i}")

    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(write, range(4)))
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == ["set_1", "set_2", "set_3", "set_4"]
    for i, p in enumerate(paths):
        assert tables.read_info(spark, p)["description"] == f"d{i}" and tables.read_dataset(spark, p).count() == i + 1
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_a_crash_leaves_no_version_without_info(spark, tmp_path, monkeypatch):
    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(tables, "write_info", crash)
    with pytest.raises(RuntimeError):
        tables.write_versioned(spark.range(3), str(tmp_path), "set")
    assert not (tmp_path / "set_1").exists()


def test_a_large_packed_file_is_spread(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s.tsv.gz")
    with gzip.open(path, "wt", encoding="utf8") as f:
        f.write("a\tb\n" + "".join(f"{i}\t{i * 7919 % 10007}\n" for i in range(5000)))
    assert tsv.read_tsv(spark, path).rdd.getNumPartitions() == 1
    monkeypatch.setattr(tsv, "BYTES_PER_TASK", 5000)
    rows = tsv.read_tsv(spark, path)
    assert rows.rdd.getNumPartitions() > 2 and rows.count() == 5000


def test_tsv_without_quoting(spark, tmp_path):
    path = str(tmp_path / "s.tsv.gz")
    lines = ["split\tscore\tsentence1\tsentence2", 'test\t2.5\t"open\tback\\slash', "train\t5\ta\tb", 'test\t5.0\tit"s "x"\té', "test\t1.0\tshort"]
    with gzip.open(path, "wt", encoding="utf8") as f:
        f.write("\n".join(lines) + "\n")
    rows = tsv.read_tsv(spark, path, partitions=3)
    assert rows.count() == 4 and rows.rdd.getNumPartitions() == 3
    got = {tuple(r) for r in scored_sentences(rows).collect()}
    assert got == {('"open', "back\\slash", 0.5), ('it"s "x"', "é", 1.0), ("short", None, 0.2)}


def read_files(path: Path) -> dict[str, list[str]]:
    """Texts of the files of each directory, in the order of their names."""
    found = {}
    for directory in sorted(p for p in path.rglob("*") if p.is_dir()):
        parts = sorted(p for p in directory.iterdir() if p.name.startswith("part-"))
        found[directory.name] = [p.read_bytes().decode("utf8") for p in parts]
    return found


@pytest.mark.parametrize("tasks", [1, 2, 7])
def test_text_files(spark, tmp_path, tasks):
    texts = [f"line {i}\nmore\r é" if i % 3 else f"l{i}" for i in range(23)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, ""), (101, None)]
    one = spark.createDataFrame(rows, "k int, text string").repartition(5)
    two = spark.createDataFrame([(i, [f"w{i}", "x"]) for i in range(4)], "k int, words array<string>")
    path = tmp_path / "out"
    text_files.write_text_files([("one", one, "k"), ("two", two, "k")], str(path), 10, tasks=tasks)
    # A directory for each dataset, none for a file.
    want = {
        "dataset=one": ["".join(t + "\n" for t in texts[10 * f : 10 * f + 10]) for f in range(3)],
        "dataset=two": ["".join(f"w{i} x\n" for i in range(4))],
    }
    assert read_files(path) == want
    back = {(r.dataset, r.file_index): r.content for r in text_files.read_text_files(spark, str(path)).collect()}
    assert back == {(d.removeprefix("dataset="), i): c for d, files in want.items() for i, c in enumerate(files)}
    with pytest.raises(Exception, match="(?i)exist"):
        text_files.write_text_files([("one", one, "k")], str(path), 10)


def test_text_files_of_wrong_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, text string")
    with pytest.raises(Exception, match="unique and not null"):
        text_files.write_text_files([("one", df, "k")], str(tmp_path / "out"))


def test_full_last_file_leaves_no_empty_one(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "k int, text string")
    assert {r.file_index for r in text_files.text_chunks(df, "k", 10).collect()} == {0, 1}
    assert text_files.text_chunks(df.limit(0), "k", 10).count() == 0
    with pytest.raises(ValueError):
        text_files.text_chunks(df.select("k"), "k", 10)
    with pytest.raises(ValueError):
        text_files.text_chunks(df, "k", 0)


def test_training_data(spark):
    pairs = spark.createDataFrame(
        [("a", "b", "similar"), ("a", "c", "dissimilar"), ("b", "c", "not_similar"), ("a", "d", None)],
        "sentence1 string, sentence2 string, label string",
    )
    got = {(tuple(r.texts), r.label) for r in training_examples(pairs).collect()}
    assert got == {(("a", "b"), 1.0), (("a", "c"), 0.0), (("b", "c"), 0.0), (("a", "d"), 0.0)}
    assert sorted(r.sentence for r in distinct_sentences(pairs).collect()) == ["a", "b", "c", "d"]


def test_text_pair_job(spark, tmp_path):
    rows = [(i, f"t{i}", "ab"[i % 2], "train" if i < 8 else "test") for i in range(12)]
    tables.write_dataset(spark.createDataFrame(rows, "key int, text string, label string, split string"), str(tmp_path / "in"))
    jobs.build_text_pairs(spark, str(tmp_path / "in"), str(tmp_path / "out"), "key", partners=1)
    sizes = tables.read_dataset(spark, str(tmp_path / "out")).groupBy("split", "label").count().collect()
    assert {(r.split, r.label): r["count"] for r in sizes} == {
        ("train", "similar"): 8, ("train", "dissimilar"): 8, ("test", "similar"): 4, ("test", "dissimilar"): 4
    }
    examples = jobs.read_training_examples(spark, str(tmp_path / "out"), "test")
    assert sorted(r.label for r in examples.collect()) == [0.0] * 4 + [1.0] * 4


def test_entity_pair_job(spark, tmp_path):
    rows = [(i, ["A", "b"], [i % 3, 0], "train" if i < 6 else "test") for i in range(9)]
    df = spark.createDataFrame(rows, "document_id int, tokens array<string>, ner_tags array<int>, split string")
    tables.write_dataset(with_label_names(df, "ner_tags", ["O", "B-x", "I-y"]), str(tmp_path / "in"))
    jobs.build_entity_pairs(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    sizes = tables.read_dataset(spark, str(tmp_path / "out")).groupBy("split", "label").count().collect()
    assert {(r.split, r.label): r["count"] for r in sizes} == {
        ("train", "similar"): 4, ("train", "not_similar"): 8, ("test", "similar"): 2, ("test", "not_similar"): 4
    }


def test_merge_job(spark, tmp_path):
    def part(names, first, n):
        df = spark.range(n).select(
            F.array(F.concat(F.lit(names[1]), "id")).alias("tokens"),
            F.array(F.lit(1)).alias("ner_tags"),
            (F.col("id") + first).cast("int").alias("document_id"),
        )
        return with_label_names(df, "ner_tags", names)

    path = jobs.merge_and_save([part(["O", "a"], 50, 60), part(["O", "b"], 0, 40)], str(tmp_path))
    back = tables.read_dataset(spark, path)
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 70, "validation": 15, "test": 15}
    assert sorted(r.document_id for r in back.collect()) == list(range(100))
    assert label_names(back, "ner_tags") == ["O", "a", "b"]


def test_text_file_job(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "train" if i < 5 else "test") for i in range(7)], "k int, text string, split string")
    tables.write_dataset(df, str(tmp_path / "in"))
    jobs.convert_to_text_files(spark, {"d": str(tmp_path / "in")}, str(tmp_path / "out"), "k", 3)
    assert read_files(tmp_path / "out") == {"dataset=d": ["t0\nt1\nt2\n", "t3\nt4\n"]}
