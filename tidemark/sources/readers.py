"""Batch and streaming sources."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.operators.joins import fits_broadcast
from tidemark.schemas import DATE_PARTS, DEVICE_MESSAGE
from tidemark.session import cut_lineage

# Hours of a range that are opened by name; a longer range lists the tree.
LISTED_HOURS = 1_000


def read_stream(spark: SparkSession, kind: str, **options: object) -> DataFrame:
    """A streaming DataFrame whose ``value`` column holds one message per row.

    ``kind='kafka'`` takes ``servers`` and ``topic``, and optionally
    ``starting_offsets`` (a new query starts at the latest message by default)
    ``max_per_trigger`` messages and ``min_partitions``, which lets several tasks
    share a crowded topic partition. ``kind='files'`` takes ``path``, and
    optionally ``format``, ``schema`` and ``max_per_trigger`` files.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").options(**kafka_options(**options))
        return reader.load()
    if kind == "files":
        return _read_file_stream(spark, **options)
    raise ValueError(f"unknown stream kind: {kind}")


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets:
        options["startingOffsets"] = starting_offsets
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def _read_file_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: StructType | str = "value string",
    max_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(format).schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path)


def parse_json(
    df: DataFrame,
    column: str = "value",
    schema: StructType = DEVICE_MESSAGE,
    bad: str = "keep",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Parse a JSON payload, text or binary, and flatten it to the fields of ``schema``.

    A payload is bad when a field declared non-nullable is missing, mistyped or
    the text is no JSON. ``bad='keep'`` leaves the unknown fields null,
    ``'drop'`` removes such rows, ``'split'`` returns (good rows, bad payloads) and ``'mark'`` all
    rows with ``good`` and, where that is false, the ``payload``.
    """
    # A generator, unlike a projection, lets no filter slip below it: Spark would
    # parse the text again for every field the filter looks at.
    parsed = F.inline(F.array(F.from_json("_payload", schema)))
    rows = df.select(F.col(column).cast("string").alias("_payload")).select("_payload", parsed)
    fields = schema.fieldNames()
    good = F.lit(True)
    for field in schema.fields:
        if not field.nullable:
            good = good & F.col(field.name).isNotNull()
    if bad == "keep":
        return rows.select(*fields)
    if bad == "drop":
        return rows.where(good).select(*fields)
    if bad == "mark":
        return rows.select(*fields, good.alias("good"), F.when(~good, F.col("_payload")).alias("payload"))
    if bad == "split":
        return rows.where(good).select(*fields), rows.where(~good).select(F.col("_payload").alias("payload"))
    raise ValueError(f"unknown treatment of bad payloads: {bad}")


def read_dimension(
    spark: SparkSession,
    jdbc: Mapping[str, str],
    table: str,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table over JDBC. ``jdbc`` holds url, user, password and driver.

    ``partition = (column, lower, upper, count)`` reads with ``count`` parallel
    connections; without it one task reads everything, which suits a small
    dimension only.
    """
    reader = spark.read.format("jdbc").options(**jdbc_read_options(jdbc, table, partition, fetch_size))
    return reader.load()


def jdbc_read_options(
    jdbc: Mapping[str, str],
    table: str,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {**jdbc, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition:
        column, lower, upper, count = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(count),
        }
    return options


def _as_utc(when: datetime) -> datetime:
    """A time in UTC; one without a zone is taken as such."""
    return when.astimezone(timezone.utc) if when.tzinfo else when.replace(tzinfo=timezone.utc)


def read_hour(spark: SparkSession, path: str, when: datetime, schema: StructType | None = None) -> DataFrame:
    """One hour of a table partitioned by year, month, day and hour (UTC).

    Only that directory is read. Giving the ``schema`` saves discovering it.
    """
    floor = _as_utc(when).replace(minute=0, second=0, microsecond=0)
    return read_hours(spark, path, floor, floor + timedelta(hours=1), schema)


def read_hours(
    spark: SparkSession, path: str, start: datetime, end: datetime, schema: StructType | None = None
) -> DataFrame:
    """The hours from ``start`` up to, not including, ``end``; only their directories are read.

    Up to ``LISTED_HOURS`` hours of a table with a schema are opened by name, so the rest of the tree isn't even listed. A table that
    a stream writes has a log that names the files that count; it is read as a whole and pruned.
    """
    if schema is not None and not _exists(spark, f"{path}/_spark_metadata"):
        first = _as_utc(start).replace(minute=0, second=0, microsecond=0)
        count = max(0, math.ceil((_as_utc(end) - first).total_seconds() / 3600))
        if count <= LISTED_HOURS:
            hours = [first + timedelta(hours=i) for i in range(count)]
            folders = [f"{path}/year={h.year}/month={h.month}/day={h.day}/hour={h.hour}" for h in hours]
            found = [folder for folder in folders if _exists(spark, folder)]
            if not found:
                return spark.createDataFrame([], _with_parts(schema))
            return spark.read.schema(_with_parts(schema)).option("basePath", path).parquet(*found)
    number = ((F.col("year") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")
    return _landed(spark, path, schema).where(
        (number >= _hour_number(start)) & (number < _hour_number(end, round_up=True))
    )


def _with_parts(schema: StructType) -> StructType:
    """``schema`` with the partition columns at its end, as a read of the whole table has it."""
    fields = [f for f in schema.fields if f.name not in DATE_PARTS]
    return StructType([*fields, *(StructField(name, IntegerType()) for name in DATE_PARTS)])


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _hour_number(when: datetime, round_up: bool = False) -> int:
    when = _as_utc(when)
    floor = when.replace(minute=0, second=0, microsecond=0)
    if round_up and floor != when:
        floor += timedelta(hours=1)
    return ((floor.year * 100 + floor.month) * 100 + floor.day) * 100 + floor.hour


def _landed(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def snake_case(name: str) -> str:
    """``Room.Type`` or ``Room Type`` as ``room_type``."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
    separator: str = ";",
    multi_line: bool = False,
    split: bool = False,
) -> DataFrame:
    """Separated text with a header; ``NA`` and empty numbers are null, names become snake case.

    A ``schema`` gives the types of columns by their name in snake case, in any order; the columns it does not name are left out
    and one that is missing in the header is refused. Without a schema Spark infers types in an extra pass.
    ``multi_line`` allows line breaks inside quotes but makes a file unsplittable: one task reads it all. With ``split``
    and a schema several tasks share a file, see :func:`read_records`, if quotes stand around whole fields only.
    """
    options = {
        "sep": separator,
        "header": True,
        "nullValue": "NA",
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
    }
    # Without inference this reads the header alone.
    header = [snake_case(name) for name in spark.read.options(**options).csv(path).columns]
    if schema is None:
        if split:
            raise ValueError("splitting files needs a schema")
        df = spark.read.options(**options, inferSchema=True).csv(path).toDF(*header)
        return df.select(*columns) if columns else df
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {snake_case(field.name): field for field in wanted.fields}
    missing = [name for name in kinds if name not in header]
    if missing:
        raise ValueError(f"no column {missing} in {header}")
    # Columns of the file in its own order; the reader then drops what is not wanted.
    fields = [
        StructField(name, kinds[name].dataType if name in kinds else StringType()) for name in header
    ]
    if split:
        df = parse_records(read_records(spark, path), StructType(fields), options)
    else:
        df = spark.read.options(**options, enforceSchema=True).schema(StructType(fields)).csv(path)
    df = df.select(*[F.col(name).alias(field.name) for name, field in kinds.items()])
    return df.select(*columns) if columns else df


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """(file, block, line, odd): lines of text by the block of the file they start in, and whether their quotes are odd."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
        (quotes % 2).cast("int").alias("odd"),
    )


def read_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, record, first): the records of separated text, which may have line breaks inside quotes.

    Files are read in blocks by many tasks. A line break ends a record if the quotes before it are even: a first pass counts the quotes
    of each block, so that the second knows whether a block starts inside a record. Records within a block are put together
    where they are read; only the pieces at the ends of blocks are shuffled and joined. ``first`` marks the first record of a file.
    Quotes must enclose whole fields, with quotes inside doubled. Empty lines between records are left out.
    """
    lines = _lines(spark, path, quote)
    blocks = cut_lineage(lines.groupBy("file", "block").agg(F.sum("odd").alias("odd")), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("open"))
    inside = cut_lineage(inside, "blocks")
    if fits_broadcast(inside):
        lines = lines.join(F.broadcast(inside), ["file", "block"])
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        met = numbered.join(inside, ["file", "block"]).repartition("file", "block")
        lines = met.sortWithinPartitions("file", "block", "at").drop("at")
    shape = "file string, block long, kind int, record string"
    pieces = lines.select("file", "block", "line", "odd", "open").mapInArrow(_together, shape)
    pieces = cut_lineage(pieces, "records")
    whole = pieces.where(f"kind = {WHOLE}").select("file", "record", (F.col("block") < 0).alias("first"))
    # A record that leaves its block: its start, whole blocks inside it, and its end, joined in the order of the blocks.
    parts = pieces.where(f"kind <> {WHOLE}")
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("n", F.sum(F.when(F.col("kind") == START, 1).otherwise(0)).over(order))
    listed = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    joined = parts.groupBy("file", "n").agg(listed.alias("pieces"))
    joined = joined.select("file", F.array_join("pieces.record", "\n").alias("record"), (F.col("pieces")[0]["block"] < 0).alias("first"))
    return whole.unionByName(joined).where("record NOT IN ('', '\r')")


# What a piece is: the end of a record begun in an earlier block, a record, the start of one that goes on.
END, WHOLE, START = 0, 1, 2


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and their pieces from the lines of blocks, in order; -1 - block for the first record of a file."""
    now, held, begun, first = None, [], False, False

    def row(kind: int) -> tuple:
        file, block = now
        return file, -1 - block if first and kind != END else block, kind, "\n".join(held)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "block", "line", "odd", "open")]
        out = []
        for file, block, line, odd, inside in zip(*columns, strict=True):
            if (file, block) != now:
                if held:
                    out.append(row(START if begun else END))
                now, held, begun, open_, first = (file, block), [], not inside, inside, block == 0
            held.append(line)
            open_ ^= odd
            if not open_:
                out.append(row(WHOLE if begun else END))
                held, begun, first = [], True, False
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), PIECE, strict=True)], ["file", "block", "kind", "record"]
            )
    if held:
        last = zip(row(START if begun else END), PIECE, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in last], ["file", "block", "kind", "record"])


PIECE = (pa.string(), pa.int64(), pa.int32(), pa.string())


def parse_records(records: DataFrame, schema: StructType, options: Mapping[str, object]) -> DataFrame:
    """Records of separated text as columns; the first of every file is its header."""
    text = F.regexp_replace("record", r"\r$", "")
    kept = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in ("header", "multiLine")}
    parsed = F.from_csv(text, _ddl(schema), kept)
    return records.where(~F.col("first")).select(parsed.alias("row")).select("row.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
