"""Speed layer: messages to landed files and to windowed metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalar import with_date_parts
from tidemark.operators.joins import enrich
from tidemark.operators.metrics import metrics_by_dims
from tidemark.schemas import DATE_PARTS
from tidemark.sources.logged import LoggedTable
from tidemark.sources.readers import parse_json
from tidemark.sources.sinks import Table
from tidemark.streaming.queries import query_id, run_queries, sink_fanout, sink_landing, sink_table
from tidemark.streaming.state import WindowSums


@dataclass(frozen=True)
class SpeedConfig:
    landing: str
    checkpoints: str
    metrics: Table
    rejected: Table | None = None
    dims: Sequence[str] = ("antenna_id", "id", "app")
    window: str = "2 minutes"
    watermark: str = "1 minute"
    available_now: bool = False
    every: str | None = None


def landing_table(config: SpeedConfig) -> LoggedTable:
    """Where the single-read layer lands messages, by year, month, day and hour."""
    return LoggedTable(config.landing, "timestamp", DATE_PARTS)


def known_messages(messages: DataFrame, dim: DataFrame, config: SpeedConfig) -> DataFrame:
    """The messages whose user is known, with the user columns that name a dimension."""
    wanted = [name for name in config.dims if name in dim.columns and name != "id"]
    return enrich(messages, dim.select("id", *wanted))


def speed_metrics(messages: DataFrame, dim: DataFrame, config: SpeedConfig) -> DataFrame:
    """Metrics of the messages whose user is known, all dimensions in one query."""
    known = known_messages(messages, dim, config)
    return metrics_by_dims(known, config.dims, config.window, watermark=config.watermark)


def run_speed_layer(
    source: DataFrame, dim: DataFrame, config: SpeedConfig, wait: bool = True
) -> list[StreamingQuery]:
    """Land all well-formed messages and write the metrics of the known users.

    ``source`` has the payload in ``value``. Malformed payloads go to
    ``config.rejected`` where one is given.

    Each output is a query of its own with its own checkpoint, so one can fail, restart or be added without the others; the price
    is that the source is read and parsed once for each of the two or three.
    """
    messages, rejected = parse_json(source, bad="split")
    timing = {"available_now": config.available_now, "every": config.every}
    starts = [
        sink_landing(messages, config.landing, f"{config.checkpoints}/landing", **timing),
        sink_table(
            speed_metrics(messages, dim, config),
            config.metrics,
            f"{config.checkpoints}/metrics",
            "speed_metrics",
            **timing,
        ),
    ]
    if config.rejected is not None:
        starts.append(
            sink_table(rejected, config.rejected, f"{config.checkpoints}/rejected", "rejected", **timing)
        )
    return run_queries(starts, wait)


def run_speed_layer_once(
    source: DataFrame, dim: DataFrame, config: SpeedConfig, wait: bool = True
) -> list[StreamingQuery]:
    """:func:`run_speed_layer` as one query: the source is read and parsed once for all outputs.

    Every micro-batch is written once and goes to the landing table, to the rejected payloads and to the window sums, each of which commits
    it under (query, batch). A failure between two of them ends the query; the restart repeats the batch, and what has been
    committed is passed over. ``config.metrics`` and the landing are logged tables; sums of open windows lie in one under
    ``config.checkpoints``. The rows are those of :func:`run_speed_layer`; a run over what is available also writes the windows that
    its last rows have closed, while an endless query writes them with its next batch.
    """
    if not isinstance(config.metrics, LoggedTable):
        raise ValueError("the single-read layer writes its metrics to a logged table")
    parsed = parse_json(source, bad="mark")
    fields = [c for c in parsed.columns if c not in ("payload", "good")]
    landing, sums = landing_table(config), WindowSums(
        LoggedTable(f"{config.checkpoints}/open"), config.metrics, config.dims, config.window, config.watermark
    )

    def good(batch: DataFrame) -> DataFrame:
        return batch.where("good").select(*fields)

    def land(batch: DataFrame, name: str, number: int) -> None:
        # An hour's rows go into few files, however many tasks read the batch.
        landing.write(with_date_parts(good(batch)).hint("rebalance", *DATE_PARTS), name, number)

    def reject(batch: DataFrame, name: str, number: int) -> None:
        config.rejected.write(batch.where("NOT good").select("payload"), name, number)

    def measure(batch: DataFrame, name: str, number: int) -> None:
        sums(known_messages(good(batch), dim, config), name, number)

    checkpoint = f"{config.checkpoints}/once"
    steps = [land, *([reject] if config.rejected is not None else []), measure]
    once = sink_fanout(parsed, steps, checkpoint, "speed_once", config.available_now, config.every)
    running = run_queries([once], wait)
    if wait and config.available_now:
        spark = source.sparkSession
        sums.flush(spark, f"speed_once-{query_id(spark, checkpoint)}")
    return running
