"""What the operators share: the registry, tables, fresh column names and bounded broadcasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rows of up to 16 bytes that one broadcast may hold: a few dozen MB as a hash table.
BROADCAST_ROWS = 500_000


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` a test compares it with a brute-force version."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text of a column; null counts as empty."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names the operator is about to add, whatever their case."""
    mine = {name.lower() for name in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in mine])


def sheltered(docs: DataFrame, names: list[str], keep: Callable[..., DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``keep`` leaves, with all their columns as they were.

    ``keep`` gets the table under plain numbered names, which clash with none that it adds, and the new ones of ``names``.
    """
    plain = {name: f"column_{i}" for i, name in enumerate(docs.columns)}
    left = keep(docs.toDF(*plain.values()), *[plain[name] for name in names])
    return left.select(*plain.values()).toDF(*docs.columns)


def numbered(docs: DataFrame, name: str, stored: bool = False) -> DataFrame:
    """``docs`` with a column that tells its rows apart and is the same wherever it is read.

    With ``stored`` the caller says that ``docs`` are rows of Parquet files, filtered and projected at most: a row's place in its
    file is its number, and nothing is written. Otherwise, or if the files give no places, the rows are written once with a number.
    """
    if stored:
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        try:
            return docs.withColumn(name, place)
        except AnalysisException:
            pass
    return cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(key: str) -> Column:
    """Whether a document is kept from training: crc32 of its key as text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it has at most ``rows`` rows.

    The join above gives the same rows either way; without the hint it shuffles.
    """
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
