import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators.positions import first_in_order, with_position, with_shuffled_position


def expected_positions(rows, group, key):
    """rows -> {row: position in its group}."""
    seen, out = {}, {}
    for r in sorted(rows, key=key):
        g = group(r)
        out[r] = seen.get(g, 0)
        seen[g] = out[r] + 1
    return out


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    # A third of the rows in one label, the rest over seven.
    return [(k * 7919 % 100_003, "hot" if k % 3 == 0 else f"l{rng.randrange(7)}", f"k{k:05d}é") for k in range(900)]


@pytest.mark.parametrize("tasks", [1, 3, 16])
@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_grouped_positions_do_not_depend_on_partitions(spark, skewed, partitions, tasks):
    df = spark.createDataFrame(skewed, "k long, label string, s string").repartition(partitions)
    got = with_position(df, "k", ["label"], tasks=tasks).collect()
    want = expected_positions(skewed, lambda r: r[1], lambda r: r[0])
    assert {(r.k, r.label, r.s): r.idx for r in got} == want


@pytest.mark.parametrize("tasks", [2, 7])
def test_string_and_composite_keys(spark, skewed, tasks):
    df = spark.createDataFrame(skewed, "k long, label string, s string")
    by_string = with_position(df, "s", tasks=tasks).collect()
    assert {(r.k, r.label, r.s): r.idx for r in by_string} == expected_positions(
        skewed, lambda r: 0, lambda r: r[2].encode()
    )
    by_both = with_position(df, ["label", "k"], tasks=tasks).collect()
    assert {(r.k, r.label, r.s): r.idx for r in by_both} == expected_positions(
        skewed, lambda r: 0, lambda r: (r[1], r[0])
    )


def test_nulls_sort_first_and_null_groups_are_kept(spark):
    rows = [(None, "a", 1), (3, "a", 2), (None, None, 3), (2, None, 4), (1, "a", 5)]
    df = spark.createDataFrame(rows, "k long, g string, u int")
    got = with_position(df, ["k", "u"], ["g"], tasks=3).collect()
    assert {r.u: r.idx for r in got} == {1: 0, 5: 1, 2: 2, 3: 0, 4: 1}


def test_running_weight(spark):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("w"))
    for tasks in (1, 9):
        got = with_position(df, "id", name="before", tasks=tasks, weight="w").collect()
        assert {r.id: r.before for r in got} == {i: sum(j % 4 for j in range(i)) for i in range(100)}


def test_empty_input(spark):
    assert with_position(spark.range(0), "id").collect() == []
    assert with_shuffled_position(spark.range(0), "id", 1).collect() == []


def test_shuffled_positions(spark):
    import hashlib

    order = sorted(range(500), key=lambda i: (hashlib.md5(f"9|s|{i}".encode()).hexdigest(), i))
    want = {k: p for p, k in enumerate(order)}
    for tasks in (2, 6):
        for parts in (1, 5):
            got = with_shuffled_position(spark.range(500).repartition(parts), "id", 9, tasks=tasks)
            assert {r.id: r.idx for r in got.collect()} == want


def test_first_in_order(spark):
    got = first_in_order(spark.range(1000).repartition(7), F.col("id") * -1, 5, tasks=4)
    assert sorted(r.id for r in got.collect()) == [995, 996, 997, 998, 999]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_window_in_any_plan(spark, monkeypatch):
    """Neither in the ranking nor in what is stored on the way; in every registered user of it."""
    from labelloom.operators import positions
    from labelloom.plans import queries

    plans = []
    write = positions.cut_lineage
    monkeypatch.setattr(positions, "cut_lineage", lambda df: (plans.append(plan_of(df)), write(df))[1])
    plans.append(plan_of(with_position(spark.range(1000), "id", tasks=4)))
    assert "rangepartitioning" in plans[0]
    for name in ("text_chunks", "shuffled_batches", "every_fifth_row", "merged_three"):
        plans.append(plan_of(queries.QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert len(plans) > 10
    assert all("SinglePartition" not in p or "Window" not in p for p in plans)


def test_wrong_keys_are_errors(spark):
    for keys in ([1, 2, 2], [1, None]):
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        with pytest.raises(Exception, match="unique and not null"):
            with_position(df, "k", unique=True).collect()
    twice = spark.createDataFrame([("a", 1), ("b", 1)], "g string, k int")
    assert {r.idx for r in with_position(twice, "k", ["g"], unique=True).collect()} == {0}


def test_equal_keys_of_any_number(spark):
    """A third of all rows without a key: each has a place of its own."""
    df = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    got = with_position(df, ["k", "id"], tasks=6).withColumn("part", F.spark_partition_id()).collect()
    assert sorted(r.idx for r in got) == list(range(900)) and all((r.idx < 300) == (r.k is None) for r in got)


def test_columns_named_like_those_of_the_core(spark):
    df = spark.range(50).select("id", *[F.lit(1).alias(c) for c in ("_at", "_n", "_stretch", "_first", "_offset", "idx2")])
    got = with_position(with_position(df, "id", name="_before", weight="_at", tasks=3), "id", tasks=2)
    assert [(r.id, r._before, r.idx) for r in got.orderBy("id").collect()] == [(i, i, i) for i in range(50)]


@pytest.mark.parametrize("kind", ["long", "string", "timestamp", "double"])
def test_runs_stay_in_one_partition(spark, kind):
    from labelloom.operators.positions import with_position_in_runs

    key = {
        "long": F.col("id") * 7919 % 1009,
        "string": F.concat(F.lit('k"é'), F.lpad((F.col("id") * 7919 % 1009).cast("string"), 5, "0")),
        "timestamp": F.timestamp_micros(F.col("id") * 7919 % 1009 + 1_700_000_000_000_000),
        "double": (F.col("id") * 7919 % 1009) / 7.0,
    }[kind]
    df = spark.range(1000).select("id", key.alias("k")).repartition(5)
    for tasks in (1, 9):
        placed = with_position_in_runs(df, "k", 7, "pos", tasks).withColumn("part", F.spark_partition_id())
        rows = placed.collect()
        # Partitions follow the order, and so do the rows inside.
        assert [r.pos for r in rows] == list(range(1000)) and [r.k for r in rows] == sorted(r.k for r in rows)
        homes = {}
        for r in rows:
            homes.setdefault(r.pos // 7, set()).add(r.part)
        assert all(len(h) == 1 for h in homes.values())
        assert len({r.part for r in rows}) == tasks
