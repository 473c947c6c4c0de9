import hashlib
from collections import Counter

import pytest

from labelloom.operators import positions
from labelloom.operators import text_pairs as TP


def draw(key):
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def brute(rows, partners, seed=42):
    """rows: (key, text, label) of one split -> Counter of pairs, by nested loops."""
    by_label = {}
    for _, text, label in sorted(r for r in rows if r[2] is not None):
        by_label.setdefault(label, []).append(text)
    labels = sorted(by_label)
    out = Counter()
    for rank, label in enumerate(labels):
        texts, q = by_label[label], 0
        for i, first in enumerate(texts):
            for step in range(1, min(partners, len(texts) - 1) + 1):
                out[(first, texts[(i + step) % len(texts)], "similar")] += 1
                o = draw(f"{seed}|d|{label}|{q}") % (len(labels) - 1)
                other = by_label[labels[o + (o >= rank)]]
                out[(first, other[draw(f"{seed}|r|{label}|{q}") % len(other)], "dissimilar")] += 1
                q += 1
    return out


def rows_of(sizes):
    return [(100 * k + i, f"{label}{i}", label) for k, (label, n) in enumerate(sizes.items()) for i in range(n)]


def pairs(df, **kw):
    return Counter((r.sentence1, r.sentence2, r.label) for r in TP.text_pairs(df, "key", **kw).collect())


CASES = [
    ({"a": 1, "b": 1}, 1),
    ({"a": 2, "b": 1}, 3),
    ({"a": 6, "b": 3, "c": 1}, 1),
    ({"a": 6, "b": 5, "c": 4}, 2),
    ({"a": 5, "b": 5}, 50),
    ({"a": 60, "b": 1}, 7),
]


@pytest.fixture(params=["broadcast", "shuffled"])
def path(request, monkeypatch):
    """Rows wanted broadcast, and without any broadcast and with tiny slots."""
    if request.param == "shuffled":
        monkeypatch.setattr(positions, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(TP, "USES_PER_SLOT", 5)
    return request.param


@pytest.mark.parametrize("sizes,partners", CASES)
def test_against_nested_loops(spark, path, sizes, partners):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows, "key long, text string, label string")
    got = pairs(df, partners=partners)
    assert got == brute(rows, partners)
    # Every row that has a partner is a first sentence.
    assert {a for a, _, _ in got} == {t for _, t, label in rows if sizes[label] > 1}


@pytest.mark.parametrize("keys", [[1, 1, 2, 2, 3, 3], [1, 2, 3, 4, 5, None]])
def test_repeated_or_null_keys_are_errors(spark, path, keys):
    rows = [(k, f"t{i}", "ab"[i % 2]) for i, k in enumerate(sorted(keys, key=str))] + [(1, "again", "a")]
    df = spark.createDataFrame(rows, "key long, text string, label string")
    with pytest.raises(Exception, match="unique and not null"):
        TP.text_pairs(df, "key").collect()


def test_partitions_and_buckets_do_not_matter(spark, path):
    rows = rows_of({"a": 9, "b": 4, "c": 7})
    df = spark.createDataFrame(rows, "key long, text string, label string")
    want = brute(rows, 3)
    for parts in (1, 3, 16):
        assert pairs(df.repartition(parts), partners=3) == want


def test_splits_are_separate(spark, path):
    first, second = rows_of({"a": 4, "b": 3}), [(k + 1000, t + "!", l) for k, t, l in rows_of({"a": 2, "c": 5})]
    df = spark.createDataFrame(
        [(*r, "train") for r in first] + [(*r, "test") for r in second], "key long, text string, label string, split string"
    )
    got = TP.text_pairs(df, "key", split="split", partners=2).collect()
    for name, rows in (("train", first), ("test", second)):
        assert Counter((r.sentence1, r.sentence2, r.label) for r in got if r.split == name) == brute(rows, 2)


def test_null_labels_are_left_out(spark):
    rows = rows_of({"a": 3, "b": 2}) + [(999, "none", None)]
    df = spark.createDataFrame(rows, "key long, text string, label string")
    assert pairs(df) == brute(rows, 1)


def test_integer_labels(spark):
    rows = [(i, f"t{i}", i % 3) for i in range(11)]
    df = spark.createDataFrame(rows, "key long, text string, label int")
    assert pairs(df, partners=3) == brute(rows, 3)


def test_empty_input_and_single_label(spark):
    schema = "key long, text string, label string"
    assert TP.text_pairs(spark.createDataFrame([], schema), "key").count() == 0
    alone = spark.createDataFrame(rows_of({"a": 3}), schema)
    with pytest.raises(ValueError, match="two labels"):
        TP.text_pairs(alone, "key")
    assert TP.text_pairs(alone, "key", kinds=[TP.SIMILAR]).count() == 3
    assert TP.text_pairs(spark.createDataFrame(rows_of({"a": 1}), schema), "key").count() == 0


def test_wide_text_is_scanned_once(spark, tmp_path, path):
    """The rows wanted come from one scan of the text, and nothing is a cross join."""
    rows = rows_of({"a": 30, "b": 20})
    spark.createDataFrame(rows, "key long, text string, label string").write.parquet(str(tmp_path / "t"))
    out = TP.text_pairs(spark.read.parquet(str(tmp_path / "t")), "key", partners=4)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "text#" in line]
    assert len(scans) == 1, plan


def test_pair_key_is_unique(spark, path):
    df = spark.createDataFrame(rows_of({"a": 6, "b": 4}), "key long, text string, label string")
    got = TP.text_pairs(df, "key", pair_key="pair").collect()
    assert len({r.pair for r in got}) == len(got) == 20

