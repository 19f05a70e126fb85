from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.operators import regress


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]]) + [100, -3, 5]
    y = 7 + x @ [1.5, -2.0, 0.25] + rng.normal(size=400)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "key int, x1 double, x2 double, x3 double, y double")
    return df.repartition(6), x, y


@pytest.fixture(scope="module")
def fit(data):
    return regress.fit_ols(data[0], "y", ["x1", "x2", "x3"])


def test_fit_against_numpy(data, fit):
    _, x, y = data
    solved, *_ = np.linalg.lstsq(np.column_stack([np.ones(400), x]), y, rcond=None)
    assert np.allclose([fit.intercept, *fit.slopes], solved, rtol=1e-9)


def test_summary_against_ml(spark, data, fit):
    df, _, _ = data
    vectors = VectorAssembler(inputCols=["x1", "x2", "x3"], outputCol="features").transform(df)
    summary = LinearRegression(labelCol="y", solver="normal").fit(vectors).summary
    table = {r.term: r for r in regress.ols_table(spark, fit).collect()}
    terms = [table[t] for t in ("x1", "x2", "x3", "intercept")]
    assert np.allclose([r.std_error for r in terms], summary.coefficientStandardErrors, rtol=1e-7)
    assert np.allclose([r.t for r in terms], summary.tValues, rtol=1e-6)
    assert np.allclose([r.p for r in terms], summary.pValues, atol=1e-10)
    stats = regress.ols_fit_stats(spark, fit).first()
    assert stats.r2 == pytest.approx(summary.r2) and stats.r2_adjusted == pytest.approx(summary.r2adj)
    assert stats.df_residual == summary.degreesOfFreedom == 396


def test_diagnostics_against_hat_matrix(data, fit):
    df, x, y = data
    design = np.column_stack([np.ones(400), x])
    hat = design @ np.linalg.inv(design.T @ design) @ design.T
    residual = y - hat @ y
    sigma = np.sqrt(residual @ residual / 396)
    found = sorted(regress.ols_diagnostics(df, fit, key="key").collect(), key=lambda r: r.key)
    h = np.diag(hat)
    standard = residual / (sigma * np.sqrt(1 - h))
    assert np.allclose([r.leverage for r in found], h, rtol=1e-8)
    assert np.allclose([r.std_residual for r in found], standard, atol=1e-8)
    assert np.allclose([r.cooks for r in found], standard**2 * h / (1 - h) / 4, atol=1e-9)
    place = standard.argsort().argsort()
    expected = [NormalDist().inv_cdf((p + 0.5) / 400) for p in place]
    assert np.allclose([r.normal_quantile for r in found], expected, atol=1e-9)


def test_unknown_predictor_gives_unknown_prediction(spark, fit):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, 1.0, 2.0)], "x1 double, x2 double, x3 double")
    found = [r.predicted for r in regress.predict_ols(df, fit).collect()]
    assert found[0] is None and found[1] is not None


def test_fit_skips_incomplete_rows(spark, data, fit):
    df, _, _ = data
    more = spark.createDataFrame([(900, None, 1.0, 1.0, 5.0), (901, 1.0, 1.0, 1.0, None)], df.schema)
    again = regress.fit_ols(df.unionByName(more), "y", ["x1", "x2", "x3"])
    assert np.allclose(again.slopes, fit.slopes) and again.n == 400
    assert again.ss_residual == pytest.approx(fit.ss_residual)


def test_collinear_and_constant_predictors_are_left_out(spark, data):
    df, _, _ = data
    wide = df.withColumns({"twice": F.col("x1") * 2 - F.col("x2"), "same": F.lit(3)})
    fit = regress.fit_ols(wide, "y", ["x1", "x2", "twice", "same"])
    plain = regress.fit_ols(df, "y", ["x1", "x2"])
    assert fit.aliased == ("twice", "same")
    assert np.allclose(fit.slopes, plain.slopes)
    rows = {r.term: r.estimate for r in regress.ols_table(spark, fit).collect()}
    assert rows["twice"] is None and rows["x1"] == pytest.approx(plain.slopes[0])


def test_only_constant_predictors_fit_the_mean(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0)], "x int, y double")
    fit = regress.fit_ols(df, "y", ["x"])
    assert fit.intercept == 3.0 and fit.xs == ()
    assert {r.predicted for r in regress.predict_ols(df, fit).collect()} == {3.0}


def test_good_fit_keeps_its_small_residuals(spark):
    # The residual sum of squares is 16 digits below the total one.
    rows = [(float(i), 1e6 * i + (-1) ** i * 1e-2) for i in range(200)]
    fit = regress.fit_ols(spark.createDataFrame(rows, "x double, y double"), "y", ["x"])
    assert fit.ss_residual == pytest.approx(200 * 1e-4, rel=1e-2)


def test_rmse_links(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0), (None, 1.0), (2.0, None)], "y double, p double")
    assert regress.rmse(df, "y", "p").first() == (pytest.approx(5**0.5), 2)
    assert regress.rmse(df, "y", "p", "exp").first() == (pytest.approx(2**0.5), 2)
    with pytest.raises(ValueError):
        regress.rmse(df, "y", "p", "log")


def test_scenarios_take_the_cluster_of_a_group(spark):
    rows = [(float(b), c, 10.0 * b + 3 * c + 0.1 * (b % 2)) for b in range(1, 9) for c in (1, 2)]
    fit = regress.fit_ols(
        spark.createDataFrame(rows, "bedrooms double, neighb_id int, m double"), "m", ["bedrooms", "neighb_id"]
    )
    clusters = spark.createDataFrame([("north", 2), ("south", 1)], "member string, cluster int")
    asked = spark.createDataFrame([(3, "north"), (4, "north"), (5, "north"), (3, "nowhere")], "bedrooms int, hood string")
    found = regress.score_scenarios(asked, fit, clusters, "hood").collect()
    by = {(r.hood, r.bedrooms): r.predicted for r in found}
    assert by[("north", 4)] - by[("north", 3)] == pytest.approx(by[("north", 5)] - by[("north", 4)])
    assert by[("nowhere", 3)] is None and len(found) == 4


def test_impute_keeps_known_values(spark):
    df = spark.createDataFrame([(1.0, 2.1), (2.0, 3.9), (3.0, 6.0), (4.0, None), (None, None)], "x double, y double")
    found = regress.impute_ols(df, regress.fit_ols(df, "y", ["x"])).collect()
    assert [r.y for r in found][:3] == [2.1, 3.9, 6.0]
    assert found[3].y == pytest.approx(7.9) and found[4].y is None
