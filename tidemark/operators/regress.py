"""Ordinary least squares on a table, with diagnostics, scoring and imputation.

A fit takes one aggregate: the moments give the coefficients and the residual sum of squares. For a very good
fit differences of large sums would lose it, and a second one sums actual residuals. Scoring is a column expression, so a null predictor
gives a null prediction and nothing leaves generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.distributions import f_upper, normal_quantile, t_two_sided
from tidemark.functions.scalar import fill_from
from tidemark.operators.joins import join_dimension
from tidemark.operators.moments import moments
from tidemark.operators.order import global_rank, quantiles
from tidemark.operators.profile import histogram


# A predictor this close to a combination of the earlier ones adds nothing.
ALIAS_TOLERANCE = 1e-7
# A leverage this close to 1 is 1 but for rounding.
LEVERAGE_TOLERANCE = 1e-10
# A residual sum of squares above this share of the total is good to ten digits without a second pass.
RESIDUAL_SHARE = 1e-4


@dataclass(frozen=True)
class LinearFit:
    """Coefficients with what the diagnostics need; ``aliased`` predictors have none."""

    y: str
    xs: tuple[str, ...]
    aliased: tuple[str, ...]
    n: int
    intercept: float
    slopes: tuple[float, ...]
    center: tuple[float, ...]
    inverse: np.ndarray  # of the scatter of the predictors
    ss_total: float
    ss_residual: float = float("nan")
    levels: tuple[tuple[str, tuple], ...] = ()  # categorical predictors and their values, the base first

    @property
    def df_residual(self) -> int:
        return self.n - len(self.xs) - 1

    @property
    def sigma(self) -> float:
        return math.sqrt(self.ss_residual / self.df_residual) if self.df_residual > 0 else float("nan")

    @property
    def r2(self) -> float:
        return 1.0 - self.ss_residual / self.ss_total if self.ss_total > 0 else float("nan")

    @property
    def sources(self) -> list[str]:
        """The columns of a table that the predictors are made of."""
        made = set(_indicators(self.levels))
        return [x for x in (*self.xs, *self.aliased) if x not in made] + [name for name, _ in self.levels]

    def term(self, x: str) -> Column:
        """One predictor as a number: a column, or the indicator of a category."""
        return _indicators(self.levels).get(x, F.col(x).cast("double"))

    def prediction(self) -> Column:
        """The fitted value; null unless every predictor is known, and a category one of the fit."""
        total = F.lit(self.intercept)
        for slope, x in zip(self.slopes, self.xs):
            total = total + F.lit(slope) * self.term(x)
        known = F.lit(True)
        for x in self.sources:
            known = known & _known(x)
        for name, values in self.levels:
            known = known & F.col(name).isin(list(values))
        return F.when(known, total)

    def leverage(self) -> Column:
        off = [self.term(x) - F.lit(m) for x, m in zip(self.xs, self.center)]
        total = F.lit(1.0 / self.n)
        for i in range(len(off)):
            for j in range(len(off)):
                total = total + F.lit(float(self.inverse[i, j])) * off[i] * off[j]
        return total


def _known(name: str) -> Column:
    """Whether a column holds a value; not-a-number is none."""
    number = F.col(name).try_cast("double")
    return F.col(name).isNotNull() & ~F.coalesce(F.isnan(number), F.lit(False))


def _indicators(levels: Sequence[tuple[str, tuple]]) -> dict[str, Column]:
    """A 0/1 column for each value but the first of each categorical predictor."""
    return {
        f"{name}={value}": (F.col(name) == F.lit(value)).cast("double")
        for name, values in levels
        for value in values[1:]
    }


def _independent(scatter: np.ndarray) -> list[int]:
    """Positions of the predictors that are no combination of the ones before them."""
    kept: list[int] = []
    for i in range(len(scatter)):
        left = scatter[i, i]
        if kept:
            cross = scatter[kept, i]
            left -= cross @ np.linalg.solve(scatter[np.ix_(kept, kept)], cross)
        if left > ALIAS_TOLERANCE**2 * scatter[i, i]:
            kept.append(i)
    return kept


def fit_ols(df: DataFrame, y: str, xs: Sequence[str], categorical: Sequence[str] = ()) -> LinearFit:
    """Least squares of ``y`` on the numbers ``xs`` with intercept, over complete rows.

    A null or not-a-number anywhere makes a row incomplete. A predictor that is constant or a combination of
    earlier ones is left out of the equation and listed in ``aliased``. Each column in ``categorical`` enters as
    one indicator ``column=value`` for each of its values but the first in order, the base; every value is
    a coefficient, so their number must suit a matrix on the driver.
    """
    whole = reduce(lambda a, b: a & b, map(_known, [y, *xs, *categorical]))
    rows = df.where(whole)
    levels = []
    for name in categorical:
        values = tuple(row[0] for row in rows.select(name).distinct().orderBy(name).collect())
        levels.append((name, values))
    made = _indicators(levels)
    predictors = [*xs, *made]
    m = moments(rows.select(*[F.col(x) for x in xs], *[c.alias(x) for x, c in made.items()], y), [*predictors, y])
    kept = _independent(m.scatter[:-1, :-1])
    names = tuple(predictors[i] for i in kept)
    center, scatter = m.part(names)
    size = np.sqrt(np.diag(scatter))
    inverse = np.linalg.inv(scatter / np.outer(size, size)) / np.outer(size, size)
    slopes = inverse @ m.scatter[kept, -1]
    fit = LinearFit(
        y=y,
        xs=names,
        aliased=tuple(x for x in predictors if x not in names),
        n=m.n,
        intercept=float(m.mean[-1] - slopes @ center),
        slopes=tuple(map(float, slopes)),
        center=tuple(map(float, center)),
        inverse=inverse,
        ss_total=float(m.scatter[-1, -1]),
        levels=tuple(levels),
    )
    # What the sums of products leave; where that is little of the whole, differences of large sums have lost it, and the residuals
    # themselves are summed.
    left = float(fit.ss_total - slopes @ m.scatter[kept, -1])
    if left > RESIDUAL_SHARE * fit.ss_total:
        return replace(fit, ss_residual=left)
    residual = F.col(y).cast("double") - fit.prediction()
    return replace(fit, ss_residual=rows.agg(F.sum(residual * residual)).first()[0])


def ols_table(spark: SparkSession, fit: LinearFit) -> DataFrame:
    """``(term, estimate, std_error, t, p)``, the intercept first; aliased terms are null."""
    center = np.array(fit.center)
    errors = [fit.sigma * np.sqrt(1.0 / fit.n + center @ fit.inverse @ center)]
    errors += list(fit.sigma * np.sqrt(np.diag(fit.inverse)))
    rows = []
    for term, estimate, error in zip(("intercept", *fit.xs), (fit.intercept, *fit.slopes), errors):
        t = float(estimate / error) if error > 0 else float("nan")
        rows.append((term, estimate, float(error), t, t_two_sided(t, fit.df_residual)))
    rows += [(term, None, None, None, None) for term in fit.aliased]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t double, p double")


def ols_fit_stats(spark: SparkSession, fit: LinearFit) -> DataFrame:
    """One row: R-squared, adjusted R-squared, residual standard error, F and its p-value."""
    p, rest = len(fit.xs), fit.df_residual
    adjusted = 1.0 - (1.0 - fit.r2) * (fit.n - 1) / rest if rest > 0 else None
    f = f_p = None
    if p and rest > 0 and fit.ss_residual > 0:
        f = ((fit.ss_total - fit.ss_residual) / p) / (fit.ss_residual / rest)
        f_p = f_upper(f, p, rest)
    return spark.createDataFrame(
        [(fit.n, p, rest, fit.r2, adjusted, fit.sigma, f, f_p)],
        "n long, df_model long, df_residual long, r2 double, r2_adjusted double, "
        "sigma double, f double, p double",
    )


def with_residual(df: DataFrame, y: str, predicted: str, name: str = "residual") -> DataFrame:
    """Add observed minus predicted."""
    return df.withColumn(name, F.col(y) - F.col(predicted))


def residual_histogram(df: DataFrame, y: str, predicted: str, bins: int = 20) -> DataFrame:
    """Histogram of observed minus predicted."""
    return histogram(with_residual(df, y, predicted), "residual", bins)


def residual_quartiles(df: DataFrame, fit: LinearFit) -> DataFrame:
    """One row with minimum, quartiles and maximum of the residuals, exact."""
    scored = with_residual(predict_ols(df.select(fit.y, *fit.sources), fit, "_fitted"), fit.y, "_fitted")
    values = quantiles(scored, "residual", [0.0, 0.25, 0.5, 0.75, 1.0])
    return df.sparkSession.createDataFrame(
        [tuple(map(float, values))],
        "minimum double, first_quartile double, median double, third_quartile double, maximum double",
    )


def predict_ols(df: DataFrame, fit: LinearFit, name: str = "predicted") -> DataFrame:
    """Add the prediction, null where a predictor is null."""
    return df.withColumn(name, fit.prediction())


def ols_diagnostics(df: DataFrame, fit: LinearFit, key: str | Sequence[str] | None = None) -> DataFrame:
    """Fitted value, residual, leverage, standardised residual and Cook's distance by row.

    Rows that were not part of the fit for a missing value are left out. With a
    row ``key`` the theoretical normal quantile of each standardised residual is
    added, which needs its rank in the whole table. A row of leverage 1 has no
    standardised residual, distance or quantile.
    """
    p = len(fit.xs) + 1
    rows = df.where(reduce(lambda a, b: a & b, map(_known, [fit.y, *fit.sources])))
    # A row that alone decides a coefficient has leverage 1 and a residual of 0 over 0.
    left = F.when(1 - F.col("leverage") > LEVERAGE_TOLERANCE, 1 - F.col("leverage"))
    spread = F.sqrt(left)
    rows = (
        rows.withColumn("fitted", fit.prediction())
        .withColumn("residual", F.col(fit.y) - F.col("fitted"))
        .withColumn("leverage", fit.leverage())
        .withColumn("std_residual", F.try_divide(F.col("residual"), F.lit(fit.sigma) * spread))
        .withColumn("scale_location", F.sqrt(F.abs("std_residual")))
        .withColumn(
            "cooks",
            F.try_divide(
                F.pow("std_residual", F.lit(2)) * F.col("leverage"), left * p
            ),
        )
    )
    if key is None:
        return rows
    # Plotting positions; small samples use the narrower offset.
    offset = 0.375 if fit.n <= 10 else 0.5
    share = (F.col("_rank") - offset) / (fit.n + 1 - 2 * offset)
    ranked = global_rank(rows, "std_residual", key, "_rank")
    return ranked.withColumn("normal_quantile", normal_quantile(share)).drop("_rank")


def rmse(df: DataFrame, y: str, predicted: str, link: str | None = None) -> DataFrame:
    """One row: root mean squared error over the rows where both values are known numbers.

    ``link='exp'`` compares the exponential of the prediction, for models of a logarithm.
    """
    if link not in (None, "exp"):
        raise ValueError(f"unknown link: {link}")
    guess = F.exp(predicted) if link else F.col(predicted)
    gap = guess - F.col(y)
    gap = F.when(~F.isnan(gap), gap)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.count(gap).alias("n"))


def score_scenarios(
    scenarios: DataFrame,
    fit: LinearFit,
    clusters: DataFrame | None = None,
    group: str | None = None,
    cluster: str = "neighb_id",
    name: str = "predicted",
) -> DataFrame:
    """Predictions for made-up rows; ``clusters`` translates a group to its number."""
    if clusters is not None:
        lookup = clusters.select(F.col("member").alias(group), F.col("cluster").alias(cluster))
        scenarios = join_dimension(scenarios, lookup, group, "left")
    return predict_ols(scenarios, fit, name)


def impute_ols(df: DataFrame, fit: LinearFit, column: str | None = None) -> DataFrame:
    """Replace the unknown values of the response by their prediction."""
    column = column or fit.y
    known = F.when(_known(column), F.col(column).cast("double"))
    return df.withColumn(column, fill_from(known, fit.prediction()))
