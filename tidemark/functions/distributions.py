"""Tail probabilities Spark SQL lacks, as vectorised column functions.

Each function sees aggregated rows only (pairs of groups, coefficients) or a
rank, one Arrow batch at a time.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Quadrature sizes: nodes over the normal variable, over the scale and over the range.
NORMAL_NODES = 200
SCALE_NODES = 200
RANGE_NODES = 2000
RANGE_END = 40.0


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.fromiter((0.5 * math.erfc(-v / math.sqrt(2.0)) for v in x.ravel()), float).reshape(x.shape)


@lru_cache(maxsize=64)
def range_curve(groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability that the range of ``groups`` normals stays below w, with its slope.

    Sampled on an even grid of w: P(w) = k * integral of phi(z) * (Phi(z) - Phi(z - w))**(k-1).
    """
    nodes, weights = np.polynomial.legendre.leggauss(NORMAL_NODES)
    z, weights = 8.0 * nodes, 8.0 * weights
    density = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    grid = np.linspace(0.0, RANGE_END, RANGE_NODES + 1)
    upper = _normal_cdf(z)
    inside = np.clip(upper[None, :] - _normal_cdf(z[None, :] - grid[:, None]), 0.0, 1.0)
    shifted = np.exp(-0.5 * (z[None, :] - grid[:, None]) ** 2) / math.sqrt(2 * math.pi)
    k = groups
    curve = k * (inside ** (k - 1)) @ (density * weights)
    slope = k * (k - 1) * ((inside ** (k - 2)) * shifted) @ (density * weights)
    return grid, np.clip(curve, 0.0, 1.0), slope


def scale_rule(freedom: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights for s = sqrt(chi-square / freedom), weights summing to one."""
    nodes, weights = np.polynomial.legendre.leggauss(SCALE_NODES)
    spread = 10.0 / math.sqrt(2.0 * freedom)
    low, high = max(0.0, 1.0 - spread), 1.0 + spread
    s = low + (nodes + 1.0) * (high - low) / 2.0
    u = s - 1.0
    log_density = (freedom - 1.0) * np.log1p(u) - freedom * (u + 0.5 * u * u)
    weights = weights * np.exp(log_density - log_density.max())
    return s, weights / weights.sum()


class StudentizedRange:
    """Upper tail and critical value for one number of groups and degrees of freedom."""

    def __init__(self, groups: int, freedom: float):
        self.grid, self.curve, self.slope = range_curve(groups)
        self.s, self.weights = scale_rule(freedom)

    def upper_tail(self, q: np.ndarray) -> np.ndarray:
        w = np.minimum(np.abs(q)[:, None] * self.s[None, :], RANGE_END)
        step = self.grid[1]
        cell = np.minimum((w / step).astype(int), RANGE_NODES - 1)
        t = w / step - cell
        # Cubic through value and slope at both ends of the cell.
        below = (
            (1 + 2 * t) * (1 - t) ** 2 * self.curve[cell]
            + t * (1 - t) ** 2 * step * self.slope[cell]
            + t * t * (3 - 2 * t) * self.curve[cell + 1]
            + t * t * (t - 1) * step * self.slope[cell + 1]
        )
        return np.clip(1.0 - below @ self.weights, 0.0, 1.0)

    def critical(self, alpha: float) -> float:
        low, high = 0.0, 1000.0
        for _ in range(60):
            mid = (low + high) / 2
            if self.upper_tail(np.array([mid]))[0] > alpha:
                low = mid
            else:
                high = mid
        return (low + high) / 2


@F.pandas_udf(
    StructType([StructField("p", DoubleType()), StructField("critical", DoubleType())])
)
def studentized_range(
    q: pd.Series, groups: pd.Series, freedom: pd.Series, alpha: pd.Series
) -> pd.DataFrame:
    """Upper tail of ``q`` and the critical value at ``alpha``, by (groups, freedom)."""
    out = pd.DataFrame({"p": np.nan, "critical": np.nan}, index=q.index)
    known = q.notna() & (freedom > 0)
    for (k, nu, level), index in q[known].groupby([groups[known], freedom[known], alpha[known]]).groups.items():
        table = StudentizedRange(int(k), float(nu))
        out.loc[index, "p"] = table.upper_tail(q.loc[index].to_numpy(float))
        out.loc[index, "critical"] = table.critical(float(level))
    return out


# Coefficients of the rational approximations of Wichura's algorithm AS 241, for the middle, the tails
# and the far tails; numerators first, from the constant on.
QUANTILE_MIDDLE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
QUANTILE_TAIL = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9),
)
QUANTILE_FAR = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(x: Column, polynomials: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    above, below = (reduce(lambda total, c: total * x + F.lit(c), p[::-1][1:], F.lit(p[-1])) for p in polynomials)
    return above / below


def normal_quantile(share: Column) -> Column:
    """Standard normal quantile of a share strictly between 0 and 1, as a column expression; else null.

    Rational approximations accurate to about 1e-16, each within its own range.
    """
    q = share - F.lit(0.5)
    inner = F.lit(0.180625) - q * q
    edge = F.when((share > 0) & (share < 1), F.sqrt(-F.ln(F.least(share, 1 - share))))
    tail = F.when(edge <= 5, _ratio(edge - F.lit(1.6), QUANTILE_TAIL)).otherwise(
        _ratio(edge - F.lit(5.0), QUANTILE_FAR)
    )
    return F.when(F.abs(q) <= 0.425, q * _ratio(inner, QUANTILE_MIDDLE)).otherwise(F.signum(q) * tail)


def beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(1.0 - x, b, a)
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    fraction = d
    for m in range(1, 10_000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + term * d or tiny)
            c = 1.0 + term / c or tiny
            fraction *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) * fraction / a


def t_two_sided(t: float, freedom: float) -> float:
    """Two-sided p-value of a t statistic."""
    if math.isnan(t) or freedom <= 0:
        return float("nan")
    return beta_tail(freedom / (freedom + t * t), freedom / 2.0, 0.5)


def t_two_sided_column(t: Column, freedom: float) -> Column:
    """:func:`t_two_sided` of a column; null stays null."""

    @F.pandas_udf(DoubleType())
    def tail(values: pd.Series) -> pd.Series:
        return pd.Series([None if math.isnan(v) else t_two_sided(v, freedom) for v in values.astype(float)], dtype="float64")

    return F.when(t.isNotNull(), tail(t))


def f_upper(f: float, df1: float, df2: float) -> float:
    """Upper tail of an F statistic."""
    return beta_tail(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)
