"""Standardisation, principal components and nearest rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.operators.moments import moments
from tidemark.session import cut_lineage

# Queries sent to the tasks in one pass, and cells of the matrix compared at a time.
QUERY_BLOCK = 50_000
SCAN_CELLS = 4_000_000


@dataclass(frozen=True)
class Components:
    columns: tuple[str, ...]
    n: int
    center: tuple[float, ...]
    scale: tuple[float, ...]
    sdev: tuple[float, ...]
    rotation: np.ndarray  # one column for each component

    def names(self, prefix: str = "pc") -> list[str]:
        return [f"{prefix}{i + 1}" for i in range(len(self.columns))]


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _spread(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    m = moments(df, columns)
    deviation = np.sqrt(np.diag(m.scatter) / (m.n - 1)) if m.n > 1 else np.zeros(len(m.columns))
    flat = [name for name, s in zip(m.columns, deviation) if not s > 0]
    if flat:
        raise ValueError(f"cannot scale constant columns {flat}")
    return m.n, m.mean, deviation, m.scatter


def standardize(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Add each column centred and divided by its sample deviation, from the complete rows."""
    _, mean, deviation, _ = _spread(df, columns)
    return df.withColumns(
        {
            f"{prefix}{name}": (F.col(name).cast("double") - F.lit(float(m))) / F.lit(float(s))
            for name, m, s in zip(columns, mean, deviation)
        }
    )


def fit_pca(df: DataFrame, columns: Sequence[str]) -> Components:
    """All principal components of the standardised columns, over complete rows.

    The sign of a component is free; here its largest loading is positive.
    """
    n, mean, deviation, scatter = _spread(df, columns)
    correlation = scatter / (n - 1) / np.outer(deviation, deviation)
    values, vectors = np.linalg.eigh(correlation)
    order = np.argsort(values)[::-1]
    vectors = vectors[:, order]
    peak = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[peak, np.arange(len(peak))])
    sdev = np.sqrt(np.clip(values[order], 0.0, None))
    return Components(
        tuple(columns), n, tuple(map(float, mean)), tuple(map(float, deviation)),
        tuple(map(float, sdev)), vectors,
    )


def pca_table(spark: SparkSession, pca: Components) -> DataFrame:
    """Deviation, share of variance and running share of every component."""
    variance = np.square(pca.sdev)
    share = variance / variance.sum()
    rows = [
        (i + 1, float(pca.sdev[i]), float(share[i]), float(share[: i + 1].sum()))
        for i in range(len(share))
    ]
    return spark.createDataFrame(rows, "component int, sdev double, share double, cumulative double")


def pca_loadings(spark: SparkSession, pca: Components) -> DataFrame:
    """The rotation in long form ``(column, component, loading)``."""
    rows = [
        (name, j + 1, float(pca.rotation[i, j]))
        for i, name in enumerate(pca.columns)
        for j in range(len(pca.columns))
    ]
    return spark.createDataFrame(rows, "column string, component int, loading double")


def pca_scores(df: DataFrame, pca: Components, prefix: str = "pc") -> DataFrame:
    """Add the component scores; a row with a missing value gets null scores."""
    z = [
        (F.col(name).cast("double") - F.lit(m)) / F.lit(s)
        for name, m, s in zip(pca.columns, pca.center, pca.scale)
    ]
    return df.withColumns(
        {
            name: _sum([F.lit(float(pca.rotation[i, j])) * z[i] for i in range(len(z))])
            for j, name in enumerate(pca.names(prefix))
        }
    )


def pca_inverse(df: DataFrame, pca: Components, prefix: str = "pc", suffix: str = "_back") -> DataFrame:
    """Add the original columns rebuilt from the scores."""
    scores = [F.col(name) for name in pca.names(prefix)]
    return df.withColumns(
        {
            f"{name}{suffix}": _sum(
                [F.lit(float(pca.rotation[i, j])) * score for j, score in enumerate(scores)]
            )
            * F.lit(pca.scale[i])
            + F.lit(pca.center[i])
            for i, name in enumerate(pca.columns)
        }
    )


def squared_distance(columns: Sequence[str], query: Mapping[str, float]) -> Column:
    missing = [name for name in columns if query.get(name) is None]
    if missing:
        raise ValueError(f"query has no value for {missing}")
    gaps = [F.col(name) - F.lit(float(query[name])) for name in columns]
    return _sum([gap * gap for gap in gaps])


def nearest(
    df: DataFrame,
    query: Mapping[str, float],
    columns: Sequence[str],
    key: str | Sequence[str],
    k: int = 5,
) -> DataFrame:
    """The ``k`` rows nearest to ``query`` by squared Euclidean distance, ties by key.

    Every task keeps its own ``k`` best. Incomplete rows have no distance and are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return _closest(df, squared_distance(columns, query), keys, k)


def _closest(df: DataFrame, distance: Column, keys: list[str], k: int) -> DataFrame:
    measured = df.withColumn("distance", distance).where(F.col("distance").isNotNull())
    return measured.orderBy("distance", *keys).limit(k)


def nearest_similar(
    df: DataFrame, pca: Components, query: Mapping[str, float], key: str | Sequence[str], k: int = 5
) -> DataFrame:
    """The ``k`` rows nearest to a row of original values, in the space of all components.

    Turning the axes keeps distances, so they are taken between standardised
    values, without computing scores. Returns the rows with their distance.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = [name for name in pca.columns if query.get(name) is None]
    if missing:
        raise ValueError(f"query has no value for {missing}")
    gaps = [
        (F.col(name).cast("double") - F.lit(float(query[name]))) / F.lit(s)
        for name, s in zip(pca.columns, pca.scale)
    ]
    return _closest(df, _sum([gap * gap for gap in gaps]), keys, k)


def nearest_many(
    df: DataFrame,
    queries: DataFrame,
    columns: Sequence[str],
    key: str,
    query_key: str,
    k: int = 5,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_key, key, distance, place)``: the ``k`` nearest rows of every query row.

    The rows are never shuffled: ``query_block`` queries at a time are sent to the tasks, each of which
    keeps the best ``k`` by query while it reads its rows; more queries take further passes over the rows. Every
    query gets its exact answer. A query with a missing value, null or not-a-number, is refused;
    such rows are left out.
    """
    columns = list(columns)
    rows = df.select(F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns])
    rows = rows.dropna("any")
    asked = cut_lineage(
        queries.select(F.col(query_key).alias("_query"), *[F.col(c).cast("double").alias(c) for c in columns])
    )
    whole = _sum([F.col(c) for c in columns])
    total, complete = asked.agg(F.count("*"), F.count(F.when(~F.isnan(whole), whole))).first()
    if complete < total:
        raise ValueError("a query row has a missing value")
    schema = StructType(
        [
            StructField("_query", asked.schema["_query"].dataType),
            StructField("_key", rows.schema["_key"].dataType),
            StructField("distance", DoubleType()),
        ]
    )

    def best(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["_query", "distance", "_key"], kind="stable")
        return found.groupby("_query", sort=False).head(k)

    def scan(points: np.ndarray, names: np.ndarray, pdf: pd.DataFrame) -> pd.DataFrame:
        values, keys = pdf[columns].to_numpy(float), pdf["_key"].to_numpy()
        parts = []
        # One product for many queries finds the rows that can be among the best; their distances are then exact.
        some = max(1, SCAN_CELLS // max(1, len(values)))
        lengths = (values**2).sum(axis=1)
        for at in range(0, len(points), some):
            block = points[at : at + some]
            own = (block**2).sum(axis=1)
            rough = lengths[:, None] + own[None, :] - 2 * (values @ block.T)
            slack = 1e-9 * (own + (lengths.max() if len(lengths) else 0.0))
            limit = np.partition(rough, k - 1, axis=0)[k - 1] if len(values) > k else np.full(len(block), np.inf)
            for i, near in enumerate((rough <= limit + slack).T):
                near = np.flatnonzero(near)
                gap = ((values[near] - block[i]) ** 2).sum(axis=1)
                best_ = np.lexsort((keys[near], gap))[:k]
                parts.append(pd.DataFrame({"_query": names[at + i], "_key": keys[near[best_]], "distance": gap[best_]}))
        return pd.concat(parts) if parts else pd.DataFrame({f.name: [] for f in schema})

    def nearby(sent: pd.DataFrame) -> DataFrame:
        points, names = sent[columns].to_numpy(float), sent["_query"].to_numpy()

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            kept = None
            for pdf in batches:
                found = scan(points, names, pdf)
                kept = found if kept is None else best(pd.concat([kept, found]))
            if kept is not None:
                yield kept

        return rows.mapInPandas(read, schema)

    passes = max(1, -(-total // query_block))
    part = F.pmod(F.xxhash64("_query"), F.lit(passes))
    blocks = (asked.where(part == i).toPandas() for i in range(passes))
    candidates = reduce(DataFrame.unionByName, map(nearby, blocks))
    place = F.row_number().over(Window.partitionBy("_query").orderBy("distance", "_key"))
    return (
        candidates.withColumn("place", place)
        .where(F.col("place") <= k)
        .select(F.col("_query").alias(query_key), F.col("_key").alias(key), "distance", "place")
    )
