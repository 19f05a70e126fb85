"""Tables the jobs write to: files under a path, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalar import hour_label
from tidemark.operators.joins import join_dimension
from tidemark.schemas import DATE_PARTS
from tidemark.session import cut_lineage
from tidemark.sources.logged import LoggedTable
from tidemark.sources.readers import read_dimension


@dataclass(frozen=True)
class FileTable:
    """A parquet table that several jobs add to.

    Every addition goes to its own ``source=/batch=`` partition, which is replaced
    as a whole when the same batch is written again: repeating a job or replaying
    a micro-batch changes nothing.
    """

    path: str

    def write(self, df: DataFrame, source: str, batch: int | str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/source={source}/batch={batch}")

    def write_hours(self, df: DataFrame, source: str, hours: Sequence[str], ts: str = "timestamp") -> None:
        """Replace the rows of ``source`` in these UTC hours by ``df``, each hour as a batch of its own.

        An hour that has no rows any more is emptied, too.
        """
        spark, root = df.sparkSession, f"{self.path}/source={source}"
        known = _batches(spark, root)
        labelled = cut_lineage(df.withColumn("batch", hour_label(F.col(ts))), "hours")
        (
            labelled.hint("rebalance", "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(root)
        )
        stale = known.intersection(hours)
        if stale:
            stale -= {row[0] for row in labelled.select("batch").distinct().collect()}
        for hour in sorted(stale):
            df.limit(0).write.mode("overwrite").parquet(f"{root}/batch={hour}")

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        reader = spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path).drop("source", "batch")


@dataclass(frozen=True)
class JdbcTable:
    """A database table that jobs append to, at least once.

    With ``tag`` every row carries ``source`` and ``batch``, by which
    a replayed batch can be told from the first one.
    """

    jdbc: Mapping[str, str]
    table: str
    tag: bool = False
    connections: int = 16

    def options(self) -> dict[str, str]:
        return {**self.jdbc, "dbtable": self.table, "numPartitions": str(self.connections)}

    def rows(self, df: DataFrame, source: str, batch: int | str) -> DataFrame:
        if not self.tag:
            return df
        return df.withColumns({"source": F.lit(source), "batch": F.lit(str(batch))})

    def write_hours(self, df: DataFrame, source: str, hours: Sequence[str], ts: str = "timestamp") -> None:
        """Append rows; with ``tag`` their batch is the UTC hour, so that a repeated hour can be told."""
        rows = self.rows(df, source, "")
        if self.tag:
            rows = rows.withColumn("batch", hour_label(F.col(ts)))
        rows.write.format("jdbc").options(**self.options()).mode("append").save()

    def write(self, df: DataFrame, source: str, batch: int | str) -> None:
        rows = self.rows(df, source, batch)
        rows.write.format("jdbc").options(**self.options()).mode("append").save()


Table = FileTable | JdbcTable | LoggedTable


def _batches(spark: SparkSession, root: str) -> set[str]:
    """The batches a source has written so far, from the names of its folders alone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return set()
    return {status.getPath().getName().partition("=")[2] for status in files.listStatus(path) if status.isDirectory()}


def write_table(df: DataFrame, target: Table, source: str, batch: int | str) -> None:
    """Append the rows of one batch of one job to a table."""
    target.write(df, source, batch)


def ensure_tables(spark: SparkSession, tables: Mapping[str, StructType], root: str) -> None:
    """Create each missing table, empty, under ``root``; existing ones stay as they are."""
    for name, schema in tables.items():
        empty = spark.createDataFrame([], schema)
        target = f"{root}/{name}"
        if not _readable(spark, target):
            empty.write.mode("ignore").parquet(f"{target}/source=none/batch=0")


def ensure_jdbc_tables(spark: SparkSession, tables: Mapping[str, StructType], jdbc: Mapping[str, str]) -> None:
    """Create each missing table, empty, in a database, with the column types of its dialect."""
    for name, schema in tables.items():
        writer = spark.createDataFrame([], schema).write.format("jdbc").options(**jdbc)
        writer.option("dbtable", name).mode("ignore").save()


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def _replaced(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key."""
    return join_dimension(old, new.select(key), key, "left_anti").unionByName(new)


def _refuse_double_keys(df: DataFrame, key: str) -> None:
    twice = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key {key}={twice[0][key]!r} occurs {twice[0]['count']} times")


def load_dimension(spark: SparkSession, df: DataFrame, path: str, key: str = "id") -> DataFrame:
    """Add rows to a dimension by key: a known key is replaced, a new one added.

    Every load writes the next ``version=`` directory, so a reader never meets a
    half-written table and a repeated load changes nothing. Returns the table.
    Several rows with one key in ``df`` are refused.
    """
    _refuse_double_keys(df, key)
    merged = df
    version = _latest(spark, path)
    if version:
        merged = _replaced(read_dimension_table(spark, path), df, key)
    merged.write.mode("overwrite").parquet(f"{path}/version={version + 1}")
    return read_dimension_table(spark, path)


def load_jdbc_dimension(
    spark: SparkSession, df: DataFrame, jdbc: Mapping[str, str], table: str, key: str = "id"
) -> None:
    """:func:`load_dimension` for a table in a database, which is emptied and filled again."""
    _refuse_double_keys(df, key)
    merged = cut_lineage(_replaced(read_dimension(spark, jdbc, table), df, key))
    writer = merged.write.format("jdbc").options(**jdbc, dbtable=table, truncate="true")
    writer.mode("overwrite").save()


def _latest(spark: SparkSession, path: str) -> int:
    """The latest complete version of a dimension, 0 without any, from folder names alone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = [int(name) for name in _batches(spark, path) if name.isdigit()]
    complete = [v for v in versions if files.exists(hadoop(f"{path}/version={v}/_SUCCESS"))]
    return max(complete, default=0)


def read_dimension_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of a dimension written by :func:`load_dimension`."""
    return spark.read.parquet(f"{path}/version={_latest(spark, path)}")


def compact_partitions(
    df: DataFrame, path: str, parts: Sequence[str] = DATE_PARTS
) -> None:
    """Write ``df`` partitioned by ``parts`` with few files, replacing just those partitions.

    A small partition becomes one file. Spark splits a partition above its
    advisory size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) among
    tasks, so a large or hot hour is not written by a single one.
    """
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
