"""Least squares with factors of very many levels, by elimination within groups.

The levels are never columns and never come to the driver. For one factor every group is reduced to its means and
inner products of deviations; slopes follow from their sum, and each level's own coefficient is a column
expression over its row. For two factors the rows are reduced to cells of the two, and the effects of either side are
taken out in turn until they no longer change.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.distributions import t_two_sided_column
from tidemark.operators.joins import join_dimension
from tidemark.operators.moments import moments
from tidemark.operators.regress import _independent, _known
from tidemark.session import cut_lineage

#: Rounds over both factors, and the change of an effect, in deviations of its variable, that ends them.
ROUNDS, TOLERANCE = 200, 1e-10


@dataclass(frozen=True)
class WithinFit:
    """Slopes of the numbers, and the levels of each factor as a table (level, n, effect, variance).

    An effect counts from 0 for the first factor; ``variance`` times sigma squared is its variance (None for two factors).
    """

    y: str
    xs: tuple[str, ...]
    aliased: tuple[str, ...]
    factors: tuple[str, ...]
    n: int
    parameters: int
    slopes: tuple[float, ...]
    inverse: np.ndarray
    ss_residual: float
    levels: tuple[DataFrame, ...]

    @property
    def df_residual(self) -> int:
        return self.n - self.parameters

    @property
    def sigma(self) -> float:
        return math.sqrt(max(self.ss_residual, 0.0) / self.df_residual) if self.df_residual > 0 else float("nan")


def _complete(df: DataFrame, y: str, xs: Sequence[str], factors: Sequence[str]) -> DataFrame:
    whole = reduce(lambda a, b: a & b, map(_known, [y, *xs, *factors]))
    return df.where(whole).select(
        *[F.col(f) for f in factors], *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate([*xs, y])]
    )


def _solved(scatter: np.ndarray, total: np.ndarray, xs: Sequence[str]):
    """Slopes from inner products of deviations; what doesn't vary within the levels is aliased."""
    p = len(xs)
    kept = [i for i in _independent(scatter[:p, :p]) if scatter[i, i] > 1e-12 * total[i]]
    part = scatter[np.ix_(kept, kept)]
    size = np.sqrt(np.diag(part))
    inverse = np.linalg.inv(part / np.outer(size, size)) / np.outer(size, size) if kept else np.zeros((0, 0))
    slopes = inverse @ scatter[kept, p]
    residual = float(scatter[p, p] - slopes @ scatter[kept, p])
    return kept, inverse, slopes, residual


def fit_within(df: DataFrame, y: str, xs: Sequence[str], factor: str, other: str | None = None) -> WithinFit:
    """Least squares of ``y`` on the numbers ``xs`` and one or two factors, over complete rows.

    The same equation as :func:`~tidemark.operators.regress.fit_ols` with these categories, for any number of
    levels. A number that is constant within all levels, or a combination of earlier ones there, is aliased. With two
    factors the effects of the second are centred on its first level within each set of levels that rows connect.
    """
    if other is not None:
        return _fit_two(df, y, xs, factor, other)
    rows = _complete(df, y, xs, [factor])
    size = len(xs) + 1
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    # Deviations are summed around each group's own mean, so that large differences between groups take nothing away.
    groups = rows.groupBy(factor).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"v{i}").alias(f"m{i}") for i in range(size)],
        *[(F.covar_pop(f"v{i}", f"v{j}") * F.count(F.lit(1))).alias(f"s{i}_{j}") for i, j in pairs],
    )
    groups = cut_lineage(groups, "levels")
    spread = [F.sum(F.col("n") * F.col(f"m{i}") * F.col(f"m{i}")) for i in range(size)]
    row = groups.agg(F.sum("n"), F.count(F.lit(1)), *[F.sum(f"s{i}_{j}") for i, j in pairs], *spread).first()
    if not row[1]:
        raise ValueError(f"no complete rows in {[y, *xs, factor]}")
    scatter = np.zeros((size, size))
    for (i, j), value in zip(pairs, row[2 : 2 + len(pairs)]):
        scatter[i, j] = scatter[j, i] = value
    total = np.diag(scatter) + np.array(row[2 + len(pairs) :], float)
    kept, inverse, slopes, residual = _solved(scatter, total, xs)
    effect = F.col(f"m{size - 1}")
    variance = 1 / F.col("n")
    for a, i in enumerate(kept):
        effect = effect - F.lit(float(slopes[a])) * F.col(f"m{i}")
        for b, j in enumerate(kept):
            variance = variance + F.lit(float(inverse[a, b])) * F.col(f"m{i}") * F.col(f"m{j}")
    means = [F.col(f"m{i}") for i in kept]
    levels = groups.select(
        F.col(factor).alias("level"), "n", effect.alias("effect"), variance.alias("variance"), F.array(*means).alias("means")
    )
    return WithinFit(
        y=y,
        xs=tuple(xs[i] for i in kept),
        aliased=tuple(x for i, x in enumerate(xs) if i not in kept),
        factors=(factor,),
        n=int(row[0]),
        parameters=len(kept) + int(row[1]),
        slopes=tuple(map(float, slopes)),
        inverse=inverse,
        ss_residual=residual,
        levels=(levels,),
    )


def _fit_two(df: DataFrame, y: str, xs: Sequence[str], factor: str, other: str) -> WithinFit:
    rows = _complete(df, y, xs, [factor, other])
    size = len(xs) + 1
    names = [f"v{i}" for i in range(size)]
    m = moments(rows, names)
    scale = np.sqrt(np.maximum(np.diag(m.scatter) / max(m.n - 1, 1), 1e-300))
    centred = [((F.col(v) - F.lit(float(m.mean[i]))) / F.lit(float(scale[i]))).alias(v) for i, v in enumerate(names)]
    cells = rows.select(F.col(factor).alias("g"), F.col(other).alias("h"), *centred).groupBy("g", "h")
    cells = cut_lineage(cells.agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in names]), "cells")
    # Effects of either side, taken from what the other one leaves.
    ours: DataFrame | None = None
    theirs = cells.groupBy("h").agg(*[F.lit(0.0).alias(f"c{i}") for i in range(size)])
    for _ in range(ROUNDS):
        last = theirs
        ours = cut_lineage(_side(cells, theirs, "g", "h", "a", "c", size), "effects")
        theirs = cut_lineage(_side(cells, ours, "h", "g", "c", "a", size), "effects")
        gap = theirs.join(last.toDF("h", *[f"o{i}" for i in range(size)]), "h")
        moved = gap.agg(*[F.max(F.abs(F.col(f"c{i}") - F.col(f"o{i}"))) for i in range(size)]).first()
        if moved[0] is None or max(moved) < TOLERANCE:
            break
    both = cells.join(ours, "g").join(theirs, "h")
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    taken = both.agg(*[F.sum((F.col(f"a{i}") + F.col(f"c{i}")) * F.col(f"v{j}")) for i, j in pairs]).first()
    unit = m.scatter / np.outer(scale, scale)
    scatter = np.zeros((size, size))
    for (i, j), value in zip(pairs, taken):
        scatter[i, j] = scatter[j, i] = unit[i, j] - value
    kept, inverse, slopes, residual = _solved(scatter, np.diag(unit), xs)
    y_scale = scale[-1]
    real = slopes * y_scale / scale[kept]
    count_g, count_h = ours.count(), theirs.count()
    part = _connected(cells)
    parts = part.select("part").distinct().count()

    def effects(side: DataFrame, key: str, prefix: str, mean: float) -> Column:
        value = F.col(f"{prefix}{size - 1}") * F.lit(float(y_scale))
        for a, i in enumerate(kept):
            value = value - F.lit(float(real[a] * scale[i])) * F.col(f"{prefix}{i}")
        return value + F.lit(mean)

    mean = float(m.mean[-1] - real @ m.mean[kept])
    first = ours.select("g", effects(ours, "g", "a", mean).alias("effect"))
    second = theirs.join(part, "h").select("h", "part", effects(theirs, "h", "c", 0.0).alias("effect"))
    base = second.groupBy("part").agg(F.min_by("effect", "h").alias("base"))
    second = second.join(base, "part").withColumn("effect", F.col("effect") - F.col("base"))
    side = cells.join(part, "h").select("g", "part").distinct().join(base, "part")
    first = first.join(side, "g").withColumn("effect", F.col("effect") + F.col("base"))
    counts = {k: cells.groupBy(k).agg(F.sum("n").alias("n")) for k in ("g", "h")}
    levels = tuple(
        t.join(counts[k], k).select(F.col(k).alias("level"), "n", "effect") for t, k in ((first, "g"), (second, "h"))
    )
    return WithinFit(
        y=y,
        xs=tuple(xs[i] for i in kept),
        aliased=tuple(x for i, x in enumerate(xs) if i not in kept),
        factors=(factor, other),
        n=m.n,
        parameters=len(kept) + count_g + count_h - parts,
        slopes=tuple(map(float, real)),
        inverse=inverse / np.outer(scale[kept], scale[kept]),
        ss_residual=residual * float(y_scale) ** 2,
        levels=levels,
    )


def _side(cells: DataFrame, known: DataFrame, key: str, by: str, name: str, taken: str, size: int) -> DataFrame:
    """The mean of every variable by ``key`` of what the effects ``known`` of the other side leave."""
    met = join_dimension(cells, known, by)
    left = [F.sum(F.col(f"v{i}") - F.col("n") * F.col(f"{taken}{i}")) / F.sum("n") for i in range(size)]
    return met.groupBy(key).agg(*[c.alias(f"{name}{i}") for i, c in enumerate(left)])


def _connected(cells: DataFrame) -> DataFrame:
    """(h, part): the smallest level of the second factor that rows connect each of its levels with."""
    now = cut_lineage(cells.select("h").distinct().withColumn("part", F.col("h")), "parts")
    while True:
        ours = join_dimension(cells.select("g", "h"), now, "h").groupBy("g").agg(F.min("part").alias("part"))
        after = join_dimension(cells.select("g", "h"), cut_lineage(ours, "parts"), "g").groupBy("h").agg(F.min("part").alias("part"))
        # A part points on to the part of its own smallest level, so that long chains shrink by halves.
        ahead = after.select(F.col("h").alias("part"), F.col("part").alias("further"))
        after = cut_lineage(after.join(ahead, "part").select("h", F.col("further").alias("part")), "parts")
        if after.join(now, ["h", "part"], "left_anti").isEmpty():
            return after
        now = after


def within_table(df: DataFrame, fit: WithinFit) -> DataFrame:
    """``(term, estimate, std_error, t, p)`` as :func:`~tidemark.operators.regress.ols_table` has it, for one factor.

    The first level in order is the base; the others are rows ``factor=level``, as many as there are, made where the levels lie.
    """
    spark = df.sparkSession
    (factor,), (levels,) = fit.factors, fit.levels
    base = levels.orderBy("level").first()
    error = F.lit(fit.sigma) * F.sqrt("variance")
    gap = F.array(*[F.element_at("means", i + 1) - F.lit(m) for i, m in enumerate(base["means"])])
    spread = 1 / F.col("n") + F.lit(1.0 / base["n"])
    for i in range(len(fit.xs)):
        for j in range(len(fit.xs)):
            spread = spread + F.lit(float(fit.inverse[i, j])) * gap[i] * gap[j]
    level = F.col("level").cast("string")
    others = levels.where(F.col("level") != F.lit(base["level"])).select(
        F.concat(F.lit(f"{factor}="), level).alias("term"),
        (F.col("effect") - F.lit(base["effect"])).alias("estimate"),
        (F.lit(fit.sigma) * F.sqrt(spread)).alias("std_error"),
    )
    first = levels.where(F.col("level") == F.lit(base["level"])).select(
        F.lit("intercept").alias("term"), F.col("effect").alias("estimate"), error.alias("std_error")
    )
    errors = fit.sigma * np.sqrt(np.diag(fit.inverse))
    slopes = [(x, float(b), float(e)) for x, b, e in zip(fit.xs, fit.slopes, errors)]
    slopes += [(x, None, None) for x in fit.aliased]
    numbers = spark.createDataFrame(slopes, "term string, estimate double, std_error double")
    whole = first.unionByName(numbers).unionByName(others)
    whole = whole.withColumn("t", F.try_divide("estimate", "std_error"))
    return whole.withColumn("p", t_two_sided_column(F.col("t"), fit.df_residual))


def predict_within(df: DataFrame, fit: WithinFit, name: str = "predicted") -> DataFrame:
    """Add the prediction; null where a number is unknown or a level is not one of the fit."""
    total = F.lit(0.0)
    for slope, x in zip(fit.slopes, fit.xs):
        total = total + F.lit(slope) * F.when(_known(x), F.col(x).cast("double"))
    out = df.withColumn(name, total)
    for i, (factor, levels) in enumerate(zip(fit.factors, fit.levels)):
        effect = levels.select(F.col("level").alias(factor), F.col("effect").alias(f"_effect{i}"))
        out = join_dimension(out, effect, factor, "left").withColumn(name, F.col(name) + F.col(f"_effect{i}"))
        out = out.drop(f"_effect{i}")
    return out
