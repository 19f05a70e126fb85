"""Windowed metrics in one long table ``(timestamp, id, value, type)``.

Sums and counts combine inside each task before the shuffle, so a dimension
value that holds a third of the messages still sends one row per task and
window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import as_timestamp


#: Size of a distinct-count sketch, and the standard error that goes with it.
SKETCH_LG_K = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG_K / 2)


def _timed(df: DataFrame, ts: str, columns: Sequence[Column], watermark: str | None) -> DataFrame:
    timed = df.select(as_timestamp(df, ts).alias("timestamp"), *columns)
    return timed.withWatermark("timestamp", watermark) if watermark else timed


def metric_by_window(
    df: DataFrame,
    dim: str,
    length: str = "1 hour",
    watermark: str | None = None,
    ts: str = "timestamp",
    value: str = "bytes",
) -> DataFrame:
    """Sum of ``value`` by ``dim`` in tumbling windows of ``length``."""
    timed = _timed(df, ts, [F.col(dim).alias("id"), F.col(value).alias("amount")], watermark)
    return (
        timed.groupBy("id", F.window("timestamp", length))
        .agg(F.sum("amount").alias("value"))
        .select(
            F.col("window.start").alias("timestamp"),
            "id",
            "value",
            F.lit(f"{dim}_total_{value}").alias("type"),
        )
    )


def metrics_by_dims(
    df: DataFrame,
    dims: Sequence[str],
    length: str = "1 hour",
    watermark: str | None = None,
    ts: str = "timestamp",
    value: str = "bytes",
) -> DataFrame:
    """:func:`metric_by_window` for several dimensions in one scan and one shuffle.

    On a stream this needs one query and one state store instead of one for
    each dimension.
    """
    columns = [F.col(value).alias("amount")] + [F.col(dim).cast("string").alias(dim) for dim in dims]
    timed = _timed(df, ts, columns, watermark)
    long = timed.unpivot(["timestamp", "amount"], list(dims), "dim", "id")
    return (
        long.groupBy("dim", "id", F.window("timestamp", length))
        .agg(F.sum("amount").alias("value"))
        .select(
            F.col("window.start").alias("timestamp"),
            "id",
            "value",
            F.concat("dim", F.lit(f"_total_{value}")).alias("type"),
        )
    )


def distinct_by_window(
    df: DataFrame,
    keys: Sequence[str],
    counted: str,
    length: str = "1 hour",
    approx: bool = False,
    ts: str = "timestamp",
) -> DataFrame:
    """Number of distinct ``counted`` values by ``keys`` and window."""
    timed = _timed(df, ts, [F.col(name) for name in dict.fromkeys([*keys, counted])], None)
    count = F.approx_count_distinct(counted) if approx else F.count_distinct(F.col(counted))
    return (
        timed.groupBy(*keys, F.window("timestamp", length))
        .agg(count.alias("value"))
        .select(F.col("window.start").alias("timestamp"), *keys, "value")
    )


def distinct_sketches(
    df: DataFrame,
    keys: Sequence[str],
    counted: str,
    length: str = "1 hour",
    ts: str = "timestamp",
    lg_k: int = SKETCH_LG_K,
) -> DataFrame:
    """A sketch of the distinct ``counted`` values by ``keys`` and window, to be stored and merged later.

    ``(timestamp, keys, sketch)``, one row of at most ``2**lg_k`` bytes and some more for each window, however many rows it has. A table of
    them rolls up to longer windows, and over keys, without reading the rows again; a window that is computed anew
    replaces its row. Unknown values aren't counted.
    """
    timed = _timed(df, ts, [F.col(name) for name in dict.fromkeys([*keys, counted])], None)
    value = F.col(counted).cast("string")
    return (
        timed.groupBy(*keys, F.window("timestamp", length))
        .agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))
        .select(F.col("window.start").alias("timestamp"), *keys, "sketch")
    )


def roll_up_distinct(sketches: DataFrame, keys: Sequence[str], length: str = "1 day") -> DataFrame:
    """Estimated distinct values by ``keys`` and window from :func:`distinct_sketches` of shorter windows.

    ``(timestamp, keys, value, low, high)``: the estimate and three standard errors around it. ``keys`` may be fewer than those of the sketches;
    values that several of them share are counted once.
    """
    error = 3 * SKETCH_ERROR
    rolled = sketches.groupBy(*keys, F.window("timestamp", length)).agg(F.hll_union_agg("sketch").alias("sketch"))
    value = F.hll_sketch_estimate("sketch")
    found = rolled.select(F.col("window.start").alias("timestamp"), *keys, value.alias("value"))
    return found.withColumns(
        {"low": F.floor(F.col("value") / (1 + error)), "high": F.ceil(F.col("value") / (1 - error))}
    )


def count_where_by_window(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    length: str = "1 hour",
    ts: str = "timestamp",
) -> DataFrame:
    """Number of rows that meet ``condition`` by ``keys`` and window."""
    timed = _timed(df, ts, [condition.alias("hit"), *[F.col(key) for key in keys]], None)
    return (
        timed.groupBy(*keys, F.window("timestamp", length))
        .agg(F.count_if("hit").alias("value"))
        .select(F.col("window.start").alias("timestamp"), *keys, "value")
    )


def category_percent(df: DataFrame, key: str, category: str) -> DataFrame:
    """Share in percent of each ``category`` among the rows of its ``key``.

    Counts meet their totals in a join: both come from the same shuffle of counts,
    and adaptive execution splits a key that has most of the categories. A null
    key is a key of its own.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    cells = (
        df.groupBy(key, category)
        .agg(F.count("*").alias("n"))
        .withColumns({"_key": named, "_unknown": F.col(key).isNull()})
    )
    totals = cells.groupBy("_key", "_unknown").agg(F.sum("n").alias("_total"))
    return cells.join(totals, ["_key", "_unknown"]).select(
        key, category, "n", (F.col("n") * 100.0 / F.col("_total")).alias("percent")
    )
