"""Column profiles: shares, counts, contingency tables and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# Parts into which the column values of a table with empty cells are dealt.
CONTINGENCY_PARTS = 64


def null_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, percent)``: the share of nulls in percent, all columns in one pass."""
    shares = df.agg(
        *[(F.avg(F.col(name).isNull().cast("double")) * 100).alias(name) for name in columns]
    )
    return shares.unpivot([], list(columns), "column", "percent")


def value_share(df: DataFrame, column: str, value: object, percent: bool = False) -> DataFrame:
    """Share of ``value`` among the known values of ``column``, as a fraction or in percent; null if none is known."""
    share = F.try_divide(F.count_if(F.col(column) == F.lit(value)), F.count(column))
    return df.agg((share * 100 if percent else share).alias("share"))


def nonnull_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """Known values of ``column`` by group; a group without any stays with 0."""
    return df.groupBy(group).agg(F.count(column).alias("known"))


def freq(df: DataFrame, column: str) -> DataFrame:
    """Rows by value; nulls are not counted."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def contingency(df: DataFrame, row: str, column: str, zeros: bool = True) -> DataFrame:
    """``(row, column, n)`` for pairs of known values, with ``zeros`` also the empty cells.

    With ``zeros`` the result is by definition as long as the distinct rows times the distinct columns. Both come as
    tables: every row value is copied to each part of the column values and meets it in an equi-join.
    """
    cells = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row, column)
        .agg(F.count("*").alias("n"))
    )
    if not zeros:
        return cells
    cells = cut_lineage(cells, "cells")
    parts = F.explode(F.sequence(F.lit(0), F.lit(CONTINGENCY_PARTS - 1)))
    rows = cells.select(row).distinct().withColumn("_part", parts)
    names = df.where(F.col(column).isNotNull()).select(column).distinct()
    names = names.withColumn("_part", F.pmod(F.xxhash64(column), F.lit(CONTINGENCY_PARTS)).cast("int"))
    return (
        rows.join(names, "_part")
        .join(cells, [row, column], "left")
        .select(row, column, F.coalesce("n", F.lit(0)).alias("n"))
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count("*").alias("n"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The known distinct values in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def pretty_step(low: float, high: float, bins: int) -> float:
    """Bin width 1, 2, 5 or 10 times a power of ten that gives about ``bins`` bins."""
    cell = (high - low) / bins
    unit = 10.0 ** math.floor(math.log10(cell))
    step = unit
    if 2 * unit - cell < 1.5 * (cell - unit):
        step = 2 * unit
        if 5 * unit - cell < 2.75 * (cell - 2 * unit):
            step = 5 * unit
            if 10 * unit - cell < 1.5 * (cell - 5 * unit):
                step = 10 * unit
    return step


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, low, high, n)`` over about ``bins`` equal bins with round edges.

    Bins are closed on the right; the first also holds its left edge. Nulls and
    non-finite values are left out.
    """
    value = F.col(column).cast("double")
    finite = df.select(value.alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf"))
    )
    low, high = finite.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return finite.sparkSession.createDataFrame([], "bin long, low double, high double, n long")
    if low == high:
        counts = finite.agg(F.count("*").alias("n"))
        return counts.select(
            F.lit(1).cast("long").alias("bin"), F.lit(low).alias("low"), F.lit(high).alias("high"), "n"
        )
    step = pretty_step(low, high, bins)
    first, last = math.floor(low / step), math.ceil(high / step)
    # A value a rounding error away from an edge counts as lying on it.
    place = F.ceil(F.round(F.col("v") / step, 7) - first)
    counts = finite.groupBy(F.greatest(place, F.lit(1)).cast("long").alias("bin")).agg(
        F.count("*").alias("n")
    )
    every = finite.sparkSession.range(1, last - first + 1).withColumnRenamed("id", "bin")
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        ((F.col("bin") - 1 + first) * step).alias("low"),
        ((F.col("bin") + first) * step).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
