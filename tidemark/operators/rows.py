"""Projection, filters and small row-level operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in that order; the scan reads nothing else."""
    return df.select(*columns)


def keep_equal(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value; a null never matches."""
    for name, value in wanted.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def keep_nonempty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of ``subset``."""
    return df.dropna("any", subset=list(subset) if subset else None)


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``order``; each task keeps only its own ``n`` best."""
    return df.orderBy(*order).limit(n)
