from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import reduce

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) * [1, 10, 100, 1e-3] + [0, 5, -7, 40]
    rows = [(i, *map(float, row)) for i, row in enumerate(x)]
    df = spark.createDataFrame([*rows, (999, None, 1.0, 1.0, 1.0)], "key int, a double, b double, c double, d double")
    return df.repartition(5), x


@pytest.fixture(scope="module")
def pca(data):
    return reduce.fit_pca(data[0], COLUMNS)


def test_pca_against_numpy(data, pca):
    _, x = data
    values = np.linalg.eigvalsh(np.corrcoef(x.T))[::-1]
    assert np.allclose(np.square(pca.sdev), values)
    assert np.allclose(pca.rotation.T @ pca.rotation, np.eye(4))


def test_pca_against_ml(data, pca):
    df, _ = data
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(df.dropna())
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="v", outputCol="z").fit(vectors).transform(vectors)
    model = PCA(k=4, inputCol="z", outputCol="p").fit(scaled)
    assert np.allclose(np.abs(model.pc.toArray()), np.abs(pca.rotation), atol=1e-8)
    share = np.square(pca.sdev) / 4
    assert np.allclose(model.explainedVariance.toArray(), share)


def test_scores_have_the_component_deviation(data, pca):
    scores = reduce.pca_scores(data[0], pca)
    found = scores.agg(*[F.stddev_samp(n).alias(n) for n in pca.names()], *[F.avg(n).alias(f"m{n}") for n in pca.names()]).first()
    assert np.allclose(found[:4], pca.sdev) and np.allclose(found[4:], 0, atol=1e-9)
    assert scores.where("key = 999").first().pc1 is None


def test_inverse_gives_the_row_back(data, pca):
    df, _ = data
    back = reduce.pca_inverse(reduce.pca_scores(df, pca), pca).dropna()
    worst = back.agg(*[F.max(F.abs(F.col(f"{c}_back") - F.col(c)) / (1 + F.abs(c))) for c in COLUMNS]).first()
    assert max(worst) < 1e-12


def test_constant_column_is_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    with pytest.raises(ValueError, match="constant columns \\['a'\\]"):
        reduce.standardize(df, ["a", "b"])


def test_nearest_against_brute_force(data, pca):
    df, x = data
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    gap = ((z - z[17]) ** 2).sum(axis=1)
    expected = np.argsort(gap)[:5]
    query = dict(zip(COLUMNS, x[17]))
    found = reduce.nearest_similar(df, pca, query, "key").collect()
    assert [r.key for r in found] == list(expected)
    assert np.allclose([r.distance for r in found], gap[expected])
    # The same rows in the space of the scores.
    scores = reduce.pca_scores(df, pca)
    at = scores.where("key = 17").first().asDict()
    assert [r.key for r in reduce.nearest(scores, at, pca.names(), "key").collect()] == list(expected)


def test_nearest_refuses_an_incomplete_query(data, pca):
    with pytest.raises(ValueError, match="no value for \\['b'\\]"):
        reduce.nearest_similar(data[0], pca, {"a": 1.0, "c": 1.0, "d": 1.0}, "key")


@pytest.mark.parametrize("query_block", [4096, 3])
def test_nearest_many_against_brute_force(spark, query_block):
    rng = np.random.default_rng(9)
    # Whole values: many equal distances, decided by key.
    points, asked = rng.integers(0, 4, (200, 2)), rng.integers(0, 4, (10, 2))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "key long, x double, y double")
    queries = spark.createDataFrame([(f"q{i}", *map(float, p)) for i, p in enumerate(asked)], "q string, x double, y double")
    found = reduce.nearest_many(df.repartition(4), queries, ["x", "y"], "key", "q", 7, query_block).collect()
    assert len(found) == 70
    for i, point in enumerate(asked):
        gap = ((points - point) ** 2).sum(axis=1)
        expected = sorted(range(200), key=lambda j: (gap[j], j))[:7]
        assert [r.key for r in sorted((r for r in found if r.q == f"q{i}"), key=lambda r: r.place)] == expected


def test_nearest_many_with_fewer_rows_than_wanted(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 3.0)], "key long, x double")
    queries = spark.createDataFrame([("q", 1.0)], "q string, x double")
    found = reduce.nearest_many(df, queries, ["x"], "key", "q", 5).orderBy("place").collect()
    assert [(r.key, r.distance) for r in found] == [(1, 1.0), (2, 4.0)]
