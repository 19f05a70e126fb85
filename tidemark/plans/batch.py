"""Batch layer: exact hourly metrics, quota alerts and the compacted archive."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import as_timestamp
from tidemark.operators.joins import MAX_BROADCAST_ROWS, enrich, fits_broadcast, over_quota
from tidemark.operators.metrics import metric_by_window, metrics_by_dims
from tidemark.schemas import DATE_PARTS, LANDED_MESSAGE
from tidemark.session import cut_lineage
from tidemark.sources.logged import LoggedTable
from tidemark.sources.readers import read_hours
from tidemark.sources.sinks import Table, compact_partitions


@dataclass(frozen=True)
class BatchConfig:
    landing: str
    archive: str
    metrics: Table
    alerts: Table
    dims: Sequence[str] = ("antenna_id", "email", "app")
    window: str = "1 hour"
    broadcast_rows: int = MAX_BROADCAST_ROWS


def usage_by_window(messages: DataFrame, config: BatchConfig) -> DataFrame:
    """Bytes by user, the message's own dimensions and window: what both outputs are summed from.

    The columns are those of a message, with the start of the window as its time.
    """
    own = list(dict.fromkeys(["id", *(name for name in config.dims if name in messages.columns)]))
    timed = messages.select(as_timestamp(messages, "timestamp").alias("timestamp"), *own, "bytes")
    return (
        timed.groupBy(*own, F.window("timestamp", config.window))
        .agg(F.sum("bytes").alias("bytes"))
        .select(F.col("window.start").alias("timestamp"), *own, "bytes")
    )


def batch_metrics(
    messages: DataFrame, dim: DataFrame, config: BatchConfig, small: bool | None = None
) -> DataFrame:
    """Metrics of the messages whose user is known, all dimensions in one pass.

    Only the user columns that name a dimension travel to the join.
    """
    wanted = [name for name in config.dims if name in dim.columns and name != "id"]
    known = enrich(messages, dim.select("id", *wanted), max_rows=config.broadcast_rows, small=small)
    return metrics_by_dims(known, config.dims, config.window)


def quota_alerts(
    messages: DataFrame, dim: DataFrame, window: str = "1 hour", small: bool | None = None
) -> DataFrame:
    """Users above their quota within one window.

    Messages are summed by user before the join: it meets one row for each user
    and window however many messages a user sent.
    """
    return over_quota(metric_by_window(messages, "id", window), dim, small=small)


def hours_between(start: datetime, end: datetime) -> list[str]:
    """The UTC hours from ``start`` up to ``end`` as ``yyyymmddThh``; a time without a zone is UTC."""
    first, last = (t.astimezone(timezone.utc) if t.tzinfo else t.replace(tzinfo=timezone.utc) for t in (start, end))
    for when in (first, last):
        if when.minute or when.second or when.microsecond:
            raise ValueError(f"{when} is not the start of an hour")
    count = int((last - first).total_seconds()) // 3600
    return [f"{first + timedelta(hours=i):%Y%m%dT%H}" for i in range(count)]


def _refuse_uneven(window: str) -> None:
    """Refuse windows that do not divide an hour: they would cross the hours that are replaced."""
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour)s?\s*", window)
    seconds = int(found[1]) * {"second": 1, "minute": 60, "hour": 3600}[found[2]] if found else 0
    if not seconds or 3600 % seconds:
        raise ValueError(f"a window of {window!r} does not divide an hour")


def landed_hours(spark: SparkSession, landing: str, start: datetime, end: datetime) -> DataFrame:
    """The landed messages from ``start`` up to ``end``, of plain folders or of the logged table of a single-read layer."""
    table = LoggedTable(landing, "timestamp", DATE_PARTS)
    if table.snapshot(spark).version < 0:
        return read_hours(spark, landing, start, end, LANDED_MESSAGE)
    low, high = (int((t if t.tzinfo else t.replace(tzinfo=timezone.utc)).timestamp()) for t in (start, end))
    rows = table.read(spark, LANDED_MESSAGE, low=low * 1_000_000, high=high * 1_000_000 - 1)
    number = ((F.col("year") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")
    wanted = [int(label.replace("T", "")) for label in hours_between(start, end)]
    rows = rows.where((number >= min(wanted, default=0)) & (number <= max(wanted, default=-1)))
    return rows.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))


def run_batch_layer(
    spark: SparkSession,
    dim: DataFrame,
    config: BatchConfig,
    start: datetime,
    end: datetime | None = None,
) -> None:
    """Process the hours from ``start`` up to ``end``, by default one hour.

    Every hour is replaced by itself: running some of the same hours again, alone, within another range or given in another
    time zone, leaves each with its rows once. Messages are scanned once for their sums, from which
    metrics and alerts come, and once for the archive.
    """
    _refuse_uneven(config.window)
    end = end or start + timedelta(hours=1)
    hours = hours_between(start, end)
    messages = landed_hours(spark, config.landing, start, end)
    usage = cut_lineage(usage_by_window(messages, config), "usage")
    small = fits_broadcast(dim, config.broadcast_rows)
    config.metrics.write_hours(batch_metrics(usage, dim, config, small), "batch_metrics", hours)
    config.alerts.write_hours(quota_alerts(usage, dim, config.window, small), "batch_alerts", hours)
    compact_partitions(messages, config.archive)
