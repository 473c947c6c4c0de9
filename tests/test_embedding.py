import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelloom.functions.vectors import cosine
from labelloom.operators import embedding as E
from labelloom.operators import wide_pca as W


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    return rng.normal(size=(120, 6)) * np.array([9, 5, 3, 2, 1, 0.5]) + 2


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id long, embedding array<double>")


def test_components_match_centred_svd(vectors, matrix):
    model = E.fit_reducer(vectors, 4)
    got = model.pc.toArray()
    _, _, vt = np.linalg.svd(matrix - matrix.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(vt[:4].T), atol=1e-6)
    assert np.allclose(got.T @ got, np.eye(4), atol=1e-9)


def test_projection_is_uncentred_and_sliced(vectors, matrix):
    model = E.fit_reducer(vectors, 5)
    rows = E.reduce_embeddings(vectors, model, k=2).orderBy("id").collect()
    assert np.allclose(np.array([r.reduced for r in rows]), matrix @ model.pc.toArray()[:, :2])
    small = E.fit_reducer(vectors, 2)
    assert np.allclose(np.abs(small.pc.toArray()), np.abs(model.pc.toArray()[:, :2]), atol=1e-8)


def test_fit_rejects_too_many_dimensions(spark, vectors):
    assert E.fit_reducer(vectors, 2).pc.toArray().shape == (6, 2)
    with pytest.raises(ValueError, match="cannot reduce"):
        E.fit_reducer(vectors, 7)
    with pytest.raises(ValueError, match="cannot reduce"):
        E.fit_reducer(vectors.limit(0), 2)


def pairs_of(vectors):
    a = vectors.select("id", F.col("embedding").alias("u"))
    b = vectors.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("v"))
    return a.join(b, "id").withColumn("gold", (F.col("id") % 3 == 0).cast("double"))


def test_sweep(vectors, matrix):
    model = E.fit_reducer(vectors, 6)
    got = {r.k: r.score for r in E.sweep_dimensions(pairs_of(vectors), model, [6, 3, 1]).collect()}
    for k, score in got.items():
        p = matrix @ model.pc.toArray()[:, :k]
        u, v = p[:-1], p[1:]
        cos = (u * v).sum(1) / np.linalg.norm(u, axis=1) / np.linalg.norm(v, axis=1)
        assert math.isclose(score, np.corrcoef(cos, np.arange(119) % 3 == 0)[0, 1], abs_tol=1e-9)
    with pytest.raises(ValueError, match="components"):
        E.sweep_dimensions(pairs_of(vectors), model, [7])


def test_cosine_of_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([3.0, 4.0], [3.0, 4.0])], "u array<float>, v array<float>")
    assert [r.c for r in df.select(cosine(F.col("u"), F.col("v")).alias("c")).collect()] == [None, 1.0]


@pytest.mark.parametrize("tasks", [1, 6])
@pytest.mark.parametrize("hot_shares", [2, 1000])
def test_spearman_with_ties(spark, monkeypatch, tasks, hot_shares):
    monkeypatch.setattr(E, "HOT_SHARES", hot_shares)
    rng = np.random.default_rng(1)
    x = np.where(rng.random(300) < 0.35, 0.5, rng.normal(size=300).round(1))
    y = (x + rng.normal(size=300) > 0.4).astype(float)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (0.3, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    want = pd.Series(x).rank().corr(pd.Series(y).rank())
    assert math.isclose(E.spearman(df, "x", "y", tasks=tasks).first()[0], want, abs_tol=1e-12)


def test_spearman_of_constant_is_null(spark):
    assert E.spearman(spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "x double, y double"), "x", "y").first()[0] is None


def test_loss_and_pearson(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.0, 0.0), (1.0, 1.0)], "cosine double, label double")
    assert math.isclose(E.cosine_loss(df).first().loss, 0.25 / 3)
    assert math.isclose(E.pearson(df, "cosine", "label").first().pearson, np.corrcoef([0.5, 0, 1], [1, 0, 1])[0, 1])


def test_encoder_hook(spark):
    def encoder(texts):
        return np.array([[len(t), t.count("a")] for t in texts], dtype="float64").reshape(-1, 2)

    df = spark.createDataFrame([(i, "a" * i) for i in range(5)], "id int, s string").repartition(3)
    got = {r.id: list(r.embedding) for r in E.encode(df, "s", encoder).collect()}
    assert got == {i: [i, i] for i in range(5)}


def test_an_encoder_is_made_once_in_a_worker(spark):
    made = spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)

        def encoder(texts):
            # Groups hold texts of similar length, the shortest first.
            assert len(texts) <= 10 and [len(t or "") for t in texts] == sorted(len(t or "") for t in texts)
            return np.array([[len(t or ""), 1] for t in texts], dtype="float32").reshape(-1, 2)

        return encoder

    rows = [(i, None if i == 7 else "x" * (i * 7919 % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, s string").repartition(40)
    for _ in range(2):
        got = {r.id: list(r.embedding) for r in E.encode(df, "s", factory=factory, batch_size=10).collect()}
        assert got == {i: [len(t or ""), 1] for i, t in rows}
    # Far fewer than tasks: one for each worker process and call.
    assert 2 <= made.value <= 2 * 2 * 8 < 80
    with pytest.raises(ValueError, match="either"):
        E.encode(df, "s")


def test_wide_components_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, 64)) * np.linspace(3, 0.2, 64) + 1.5
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)] + [(400, None)], "id int, embedding array<double>").repartition(5)
    values, vectors = np.linalg.eigh(np.cov(rows.T))
    for k in (64, 8):
        model = W.fit_wide_reducer(df, k)
        assert np.abs(model.variances - values[::-1][:k]).max() < 1e-6
        assert np.abs(np.abs((model.components * vectors[:, ::-1][:, :k]).sum(0)) - 1).max() < 1e-5
    got = {r.id: r.reduced for r in W.reduce_wide_embeddings(df, model, k=3).collect()}
    assert got[400] is None and np.allclose(got[7], rows[7] @ model.components[:, :3])


def test_wide_components_of_very_many_dimensions(spark):
    """Twenty thousand dimensions: their covariance would take 3.2 GB."""
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(20_000, 3)))[0]
    rows = (rng.normal(size=(60, 3)) * [30, 20, 10]) @ axes.T + rng.normal(size=(60, 20_000)) * 1e-3
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "embedding array<double>").repartition(4)
    model = W.fit_wide_reducer(df, 3, extra=2)
    exact = np.linalg.svd(rows - rows.mean(0), compute_uv=False)[:3] ** 2 / 59
    assert np.abs(model.variances / exact - 1).max() < 1e-6
    with pytest.raises(ValueError, match="cannot reduce"):
        W.fit_wide_reducer(df.limit(0), 1)
