"""Factors of many levels against the fit with a column for each level."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import regress, within


def made(seed, n=400, many=9, few=4, missing=True):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        g, h = f"g{int(many * draw.random() ** 2):02d}", f"h{draw.randrange(few)}"
        x, z = draw.gauss(int(g[1:]), 1), draw.gauss(0, 3)
        y = 1000 + 2.5 * x - 0.5 * z + 7 * int(g[1:]) ** 2 + 11 * int(h[1:]) + draw.gauss(0, 1)
        hole = draw.random() if missing else 1
        rows.append((i, g if hole > 0.02 else None, h, x if hole < 0.96 else float("nan") if missing else x, z, 1.0, y))
    return rows


SHAPE = "key int, g string, h string, x double, z double, one double, y double"


def by_term(df):
    return {r["term"]: (r["estimate"], r["std_error"], r["t"], r["p"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_one_factor_equals_a_column_for_each_level(spark, seed):
    df = spark.createDataFrame(made(seed), SHAPE).repartition(4)
    plain = regress.fit_ols(df, "y", ["x", "z"], categorical=["g"])
    fit = within.fit_within(df, "y", ["x", "z", "one"], "g")
    assert fit.aliased == ("one",) and fit.n == plain.n and fit.df_residual == plain.df_residual
    assert fit.sigma == pytest.approx(plain.sigma, rel=1e-9)
    want, found = by_term(regress.ols_table(spark, plain)), by_term(within.within_table(df, fit))
    assert found.pop("one") == (None, None, None, None)
    assert found.keys() == want.keys()
    for term in want:
        assert found[term] == pytest.approx(want[term], rel=1e-6, abs=1e-9)
    both = regress.predict_ols(within.predict_within(df, fit, "a"), plain, "b").select("a", "b").collect()
    assert all((r.a is None) == (r.b is None) for r in both)
    assert [r.a for r in both if r.a is not None] == pytest.approx([r.b for r in both if r.b is not None], rel=1e-9)


def test_levels_stay_in_the_table(spark, monkeypatch):
    """As many levels as half the rows; only sums come to the driver."""
    df = spark.range(4000).selectExpr("id div 2 AS g", "cast(id % 7 AS double) AS x", "cast(id AS double) AS y")
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    fetched = []
    collect = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    fit = within.fit_within(df, "y", ["x"], "g")
    assert max(map(len, fetched), default=0) <= 1
    monkeypatch.undo()
    pairs = [(i % 7, i) for i in range(4000)]
    x, y = np.array(pairs, float).T
    x, y = x - x.reshape(-1, 2).mean(1).repeat(2), y - y.reshape(-1, 2).mean(1).repeat(2)
    assert fit.slopes[0] == pytest.approx(x @ y / (x @ x))
    assert fit.parameters == 2001 and fit.levels[0].count() == 2000


def test_two_factors_by_turns(spark):
    df = spark.createDataFrame(made(3), SHAPE).repartition(4)
    plain = regress.fit_ols(df, "y", ["x", "z"], categorical=["g", "h"])
    fit = within.fit_within(df, "y", ["x", "z"], "g", "h")
    assert fit.slopes == pytest.approx(plain.slopes[:2], rel=1e-7)
    assert fit.df_residual == plain.df_residual and fit.sigma == pytest.approx(plain.sigma, rel=1e-7)
    assert fit.inverse == pytest.approx(plain.inverse[:2, :2], rel=1e-6)
    effects = {r["level"]: r["effect"] for levels in fit.levels for r in levels.collect()}
    named = dict(zip(plain.xs, plain.slopes))
    assert effects["h0"] == pytest.approx(0, abs=1e-9)
    for level, effect in effects.items():
        if level[0] == "h" and level != "h0":
            assert effect == pytest.approx(named[f"h={level}"], rel=1e-6)
        elif level[0] == "g":
            assert effect == pytest.approx(plain.intercept + named.get(f"g={level}", 0.0), rel=1e-7)
    both = regress.predict_ols(within.predict_within(df, fit, "a"), plain, "b").where("b IS NOT NULL").select("a", "b")
    assert all(r.a == pytest.approx(r.b, rel=1e-8) for r in both.collect())


def test_two_factors_in_parts_that_no_row_connects(spark):
    """Each part loses one parameter, and predictions don't depend on where its effects are centred."""
    draw = random.Random(9)
    rows = []
    for i in range(300):
        part = i % 2
        g, h = f"g{part}{draw.randrange(4)}", f"h{part}{draw.randrange(3)}"
        x = draw.gauss(0, 1)
        rows.append((g, h, x, 3 * x + int(g[1:]) + int(h[1:]) * 2 + draw.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "g string, h string, x double, y double")
    fit = within.fit_within(df, "y", ["x"], "g", "h")
    assert fit.parameters == 1 + 8 + 6 - 2
    columns = [np.array([r[2] for r in rows])]
    columns += [np.array([float(r[i] == v) for r in rows]) for i in (0, 1) for v in sorted({r[i] for r in rows})]
    a = np.stack(columns, 1)
    y = np.array([r[3] for r in rows])
    fitted = a @ np.linalg.lstsq(a, y, rcond=None)[0]
    found = within.predict_within(df.withColumn("i", F.monotonically_increasing_id()), fit)
    got = sorted((r.g, r.h, r.x, r.predicted) for r in found.collect())
    want = sorted((r[0], r[1], r[2], f) for r, f in zip(rows, fitted))
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)


def test_no_complete_rows(spark):
    with pytest.raises(ValueError, match="no complete rows"):
        within.fit_within(spark.createDataFrame([], SHAPE), "y", ["x"], "g")
