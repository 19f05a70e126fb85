"""Windows that a stream has not closed yet: kept in a table, or read from a checkpoint."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import metrics_by_dims
from tidemark.schemas import METRIC
from tidemark.sources.logged import LoggedTable, Snapshot


def micros_of(length: str) -> int:
    """``2 minutes`` in microseconds."""
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", length)
    if not found:
        raise ValueError(f"{length!r} is not a number of seconds, minutes, hours or days")
    return int(found[1]) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[found[2]] * 1_000_000


@dataclass(frozen=True)
class WindowSums:
    """Windowed sums of micro-batches, written to ``target`` when the watermark has passed a window's end.

    It keeps the rules of a streaming aggregation in append mode. A batch writes the windows that have ended by the watermark before
    it, with its own rows in them; a row whose window has been written already is late and left out. ``state`` holds the
    partial sums of every batch, a row for each key and window of the batch, and notes the watermarks in its log; folders of
    which all windows are written are removed. State, target and removal are commits of their own under the same batch,
    and a repeated batch goes on where it stopped.
    """

    state: LoggedTable
    target: LoggedTable
    dims: Sequence[str]
    window: str
    watermark: str

    def __call__(self, rows: DataFrame, source: str, batch: int) -> None:
        spark = rows.sparkSession
        length, delay = micros_of(self.window), micros_of(self.watermark)
        self._finish(spark, _flushed(source))
        now = self.state.snapshot(spark)
        if not now.knows(source, batch):
            written, reached = _marks(now, source)
            last = rows.agg(F.max(F.unix_micros(F.col("timestamp").cast("timestamp")))).first()[0]
            marks = [w for w in (reached, None if last is None else last - delay) if w is not None]
            sums = metrics_by_dims(rows, self.dims, self.window)
            if written is not None:
                sums = sums.where(F.unix_micros("timestamp") + length > written)
            note = {"after": written, "until": reached, "reached": max(marks, default=None)}
            self.state.write(sums, source, batch, note)
        elif now.last[source] != batch:
            return
        self._finish(spark, source)

    def flush(self, spark: SparkSession, source: str) -> None:
        """Write the windows that have ended by the rows of the last batch, as a stream does when no more rows come."""
        now = self.state.snapshot(spark)
        if source not in now.last:
            return
        written, reached = _marks(now, source)
        if reached is not None and reached != written:
            empty = spark.createDataFrame([], METRIC)
            note = {"after": written, "until": reached, "reached": reached}
            self.state.write(empty, _flushed(source), now.last[source], note)
        self._finish(spark, _flushed(source))

    def _finish(self, spark: SparkSession, name: str) -> None:
        """Write the windows of the last commit of ``name`` to the target, if it hasn't got them, and drop their sums."""
        now = self.state.snapshot(spark)
        note = now.notes.get(name, {})
        if note.get("until") is None:
            return
        length, source = micros_of(self.window), name.removesuffix(FLUSH)
        if not self.target.snapshot(spark).knows(name, now.last[name]):
            end = F.unix_micros("timestamp") + length
            ended = end <= note["until"]
            low = None
            if note["after"] is not None:
                ended, low = ended & (end > note["after"]), note["after"] - length
            held = self.state.read(spark, METRIC, low=low, high=note["until"] - length, source=source).where(ended)
            closed = held.groupBy("timestamp", "id", "type").agg(F.sum("value").alias("value"))
            self.target.write(closed.select(*METRIC.fieldNames()), name, now.last[name])
        self.state.retire(spark, source, note["until"] - length + 1)


FLUSH = "/flush"


def _flushed(source: str) -> str:
    return source + FLUSH


def _marks(now: Snapshot, source: str) -> tuple[int | None, int | None]:
    """Up to where windows are written, and the watermark reached, after the last batch of a source."""
    note, end = now.notes.get(source, {}), now.notes.get(_flushed(source), {})
    flushed = now.last.get(_flushed(source), -1) == now.last.get(source, -1) >= 0
    return (end["until"] if flushed else note.get("until")), note.get("reached")


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The groups that a query with a checkpoint holds open, one row each: its keys, ``timestamp`` and sums.

    Spark's own reader of state is used, so nothing is replayed and the query may be running. Columns of the aggregation keep their names
    in the state; the window is flattened to its start.
    """
    held = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    rows = held.select("key.*", "value.*")
    return rows.withColumn("timestamp", F.col("window.start")).drop("window")
