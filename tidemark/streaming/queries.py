"""Starting and running streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.scalar import with_date_parts
from tidemark.schemas import DATE_PARTS
from tidemark.session import scratch_path
from tidemark.sources.sinks import Table


def _triggered(writer: DataStreamWriter, available_now: bool, every: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    if every:
        return writer.trigger(processingTime=every)
    return writer


def sink_landing(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "landing",
    ts: str = "timestamp",
    available_now: bool = False,
    every: str | None = None,
) -> Callable[[], StreamingQuery]:
    """Land messages as parquet by year, month, day and hour, exactly once.

    Returns a function that starts the query. Read the files through the same
    path: its log names the files that count.
    """
    writer = (
        with_date_parts(df, ts)
        .writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .partitionBy(*DATE_PARTS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, available_now, every).start


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: the same after every restart, new with a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def sink_table(
    df: DataFrame,
    target: Table,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    every: str | None = None,
) -> Callable[[], StreamingQuery]:
    """Append each micro-batch to a table, keyed by the checkpoint's query and the batch number.

    Returns a function that starts the query. The checkpoint is required: it holds
    the open windows and makes a restart repeat the batch in doubt under the
    same number. A new checkpoint counts from 0 again; it is another query with rows of its own.
    """
    if not checkpoint:
        raise ValueError(f"query {name} needs a checkpoint")
    known: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        target.write(batch, f"{name}-{known[0]}", number)

    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return _triggered(writer, available_now, every).start


Step = Callable[[DataFrame, str, int], None]


def sink_fanout(
    df: DataFrame,
    steps: Sequence[Step],
    checkpoint: str,
    name: str,
    available_now: bool = False,
    every: str | None = None,
) -> Callable[[], StreamingQuery]:
    """Give each micro-batch to several outputs in turn, reading and parsing the source once.

    A micro-batch is written to the shared folder; every step gets its rows, the name of the source (with the query's id)
    and the batch number. When a step fails, the query stops and its restart repeats the batch for all of them, so
    each must remember what it has committed: tables written under (source, batch) do.
    """
    if not checkpoint:
        raise ValueError(f"query {name} needs a checkpoint")
    known: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not known:
            known.append(query_id(spark, checkpoint))
        path = scratch_path(spark, name)
        batch.write.parquet(path)
        staged = spark.read.schema(batch.schema).parquet(path)
        for step in steps:
            step(staged, f"{name}-{known[0]}", number)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    writer = (
        df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return _triggered(writer, available_now, every).start


def run_queries(starts: Sequence[Callable[[], StreamingQuery]], wait: bool = True) -> list[StreamingQuery]:
    """Start all queries together and, with ``wait``, stay until all have ended.

    When one fails the others are stopped and its error is raised.
    """
    running: list[StreamingQuery] = []
    try:
        for start in starts:
            running.append(start())
        while wait and any(query.isActive for query in running):
            for query in running:
                query.awaitTermination(0.2)
        for query in running:
            if query.exception() is not None:
                raise query.exception()
    except BaseException:
        for query in running:
            if query.isActive:
                query.stop()
        raise
    return running
