import hashlib
import math

import pytest
from pyspark.sql import functions as F

from labelloom.operators import sampling as S


def shuffled(n, seed=42):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}|s|{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
@pytest.mark.parametrize("fractions", [S.SPLIT_70_15_15, S.SPLIT_80_10_10], ids=["70", "80"])
def test_exact_split(spark, n, fractions):
    held = math.ceil((fractions["test"] + fractions["validation"]) * n)
    test = math.ceil(fractions["test"] / (fractions["test"] + fractions["validation"]) * held)
    order = shuffled(n)
    want = {k: "test" if p < test else "validation" if p < held else "train" for p, k in enumerate(order)}
    for parts in (1, 3, 16):
        got = S.assign_splits(spark.range(n).repartition(parts), "id", fractions=fractions).collect()
        assert {r.id: r.split for r in got} == want


def test_cuts_refine_crowded_prefixes(spark, monkeypatch):
    monkeypatch.setattr(S, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(S, "ROWS_TO_SORT", 2)
    monkeypatch.setattr(S, "SMALL_SAMPLE", 0)
    got = S.sample_exactly(spark.range(300), "id", 37).collect()
    assert {r.id for r in got} == set(shuffled(300)[:37])


def test_split_of_known_sizes(spark):
    sizes = S.assign_splits(spark.range(1000), "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in sizes} == {"train": 700, "validation": 150, "test": 150}


def test_fractions_must_sum_to_one_within_rounding(spark):
    S.assign_splits(spark.range(10), "id", fractions={"train": 0.6, "validation": 0.3, "test": 0.1})
    with pytest.raises(ValueError):
        S.assign_splits(spark.range(10), "id", fractions={"train": 0.6, "validation": 0.3, "test": 0.2})


def test_splits_and_samples_do_not_shuffle_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL_SAMPLE", 0)
    df = spark.range(1000).withColumn("text", F.col("id").cast("string"))
    for out in (S.assign_splits(df, "id"), S.sample_up_to(df, "id", 10)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_samples(spark):
    df = spark.range(50)
    assert {r.id for r in S.sample_exactly(df, "id", 20).collect()} == set(shuffled(50)[:20])
    assert S.sample_exactly(df, "id", 50).count() == 50
    with pytest.raises(ValueError):
        S.sample_exactly(df, "id", 51)
    assert S.sample_up_to(df, "id", 100).count() == 50


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_small_samples_read_their_input_once(spark, parts):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(3000).repartition(parts).mapInPandas(counted, "id long").withColumn("text", F.repeat(F.lit("x"), 50))
    assert {r.id for r in S.sample_exactly(df, "id", 20).collect()} == set(shuffled(3000)[:20])
    assert reads.value == 3000
    assert {r.id for r in S.sample_up_to(df, "id", 500).collect()} == set(shuffled(3000)[:500])
    assert reads.value == 6000


def test_small_samples_of_wrong_keys(spark):
    twice = spark.createDataFrame([(i % 5, i) for i in range(10)], "k int, v int")
    with pytest.raises(ValueError, match="unique"):
        S.sample_exactly(twice, "k", 4)
    with pytest.raises(Exception, match="must not be null"):
        S.sample_up_to(spark.createDataFrame([(1,), (None,)], "k int"), "k", 1)


def test_string_and_composite_keys(spark):
    df = spark.range(200).select(F.concat(F.lit("k"), "id").alias("a"), (F.col("id") % 3).alias("b"))
    assert S.sample_exactly(df, ["a", "b"], 33).count() == 33


def test_batches(spark):
    order = {k: p for p, k in enumerate(shuffled(100))}
    for tasks in (1, 8):
        got = S.shuffled_batches(spark.range(100), "id", 32, tasks=tasks).collect()
        assert {(r.id, r.batch_id, r.batch_pos) for r in got} == {(k, p // 32, p % 32) for k, p in order.items()}
    with pytest.raises(ValueError):
        S.shuffled_batches(spark.range(3), "id", 0)


def test_every_kth(spark):
    df = spark.range(20).withColumn("g", F.col("id") % 2)
    got = S.flag_every_kth(df, "id", 3, ["g"], tasks=5).collect()
    assert {r.id for r in got if r.flagged} == {i for i in range(20) if (i // 2) % 3 == 0}
    with pytest.raises(ValueError):
        S.flag_every_kth(df, "id", 0)


@pytest.mark.parametrize("keys", [[7] * 20_000, list(range(15)) * 10, [1, 2, None]])
def test_repeated_and_null_keys_are_errors(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    with pytest.raises(ValueError, match="unique|null"):
        S.sample_exactly(df, "key", min(15, len(keys) - 1))
