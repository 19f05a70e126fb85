"""Count, means and covariances of numeric columns from a single aggregate.

Regression, standardisation and principal components all start from these few
numbers. Values are taken from a point inside the data, the middle of the first
few rows, so that large means do not swallow the differences; which point it is
does not matter to the result. Plain sums of products combine inside the tasks and
cost a fraction of as many covariance aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_ROWS = 1000


@dataclass(frozen=True)
class Moments:
    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    scatter: np.ndarray  # sums of products of deviations

    def part(self, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        at = [self.columns.index(name) for name in columns]
        return self.mean[at], self.scatter[np.ix_(at, at)]


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments over the rows complete in ``columns``."""
    columns = tuple(columns)
    p = len(columns)
    values = df.select(*[F.col(name).cast("double").alias(f"c{i}") for i, name in enumerate(columns)])
    values = values.dropna("any")
    first = values.take(FIRST_ROWS)
    if not first:
        raise ValueError(f"no complete rows in {list(columns)}")
    # Values that occur, so that a constant column comes out as exactly constant.
    start = np.sort(np.array(first, float), axis=0)[len(first) // 2]
    off = values.select(*[(F.col(f"c{i}") - F.lit(float(start[i]))).alias(f"c{i}") for i in range(p)])
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(f"c{i}") for i in range(p)]
    products = [F.sum(F.col(f"c{i}") * F.col(f"c{j}")) for i, j in pairs]
    row = off.agg(F.count("*"), *sums, *products).first()
    n = row[0]
    shift = np.array(row[1 : 1 + p], float) / n
    scatter = np.empty((p, p))
    for (i, j), total in zip(pairs, row[1 + p :]):
        scatter[i, j] = scatter[j, i] = total - n * shift[i] * shift[j]
    return Moments(columns, n, start + shift, scatter)
