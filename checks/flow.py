"""Messages: sources, sinks, joins, windowed metrics, streams and the two layers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from checks.base import DEV, DIM, LST, check, dev, dim, lst, plain_time, table
from tidemark.functions.scalar import with_date_parts
from tidemark.operators import joins, metrics
from tidemark.plans.batch import BatchConfig, batch_metrics, run_batch_layer
from tidemark.plans.speed import SpeedConfig, landing_table, run_speed_layer, run_speed_layer_once, speed_metrics
from tidemark.schemas import DEVICE_MESSAGE, LANDED_MESSAGE, METRIC, QUOTA_ALERT
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources.logged import LoggedTable, compact_stream_table
from tidemark.sources.readers import parse_json, read_delimited, read_hour, read_stream
from tidemark.sources.sinks import (
    FileTable,
    compact_partitions,
    ensure_tables,
    load_dimension,
    write_table,
)
from tidemark.streaming.queries import run_queries, sink_landing, sink_table
from tidemark.streaming.state import open_windows


SKETCHES = StructType(
    [
        StructField("timestamp", TimestampType()),
        StructField("app", StringType()),
        StructField("antenna_id", StringType()),
        StructField("sketch", BinaryType()),
    ]
)


def hourly(dim_column: str, source: str, length: str = "1 hour") -> str:
    return f"""SELECT time_bucket(INTERVAL '{length}', ts) AS timestamp, {dim_column} AS id,
       CAST(sum(bytes) AS BIGINT) AS value, '{dim_column}_total_bytes' AS type
FROM {source} GROUP BY 1, 2"""


KNOWN = "known AS (SELECT devt.*, name, email, quota FROM devt JOIN dim USING (id))"
# Windows a finished stream has closed: the watermark has passed their end.
CLOSED = """WHERE timestamp + INTERVAL 2 MINUTE <=
  (SELECT max(make_timestamp(timestamp * 1000000)) FROM dev) - INTERVAL 1 MINUTE"""


# --- windowed metrics and joins --------------------------------------------


@check("hourly_by_app", f"WITH {DEV} {hourly('app', 'devt')}")
def hourly_by_app(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(metrics.metric_by_window(dev(spark, sf), "app"))


@check("hourly_by_id", f"WITH {DEV} {hourly('id', 'devt')}")
def hourly_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(metrics.metric_by_window(dev(spark, sf), "id"))


@check("hourly_by_email", f"WITH {DEV}, {DIM}, {KNOWN} {hourly('email', 'known')}")
def hourly_by_email(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(metrics.metric_by_window(joins.enrich(dev(spark, sf), dim(spark, sf)), "email"))


METRICS_SQL = " UNION ALL ".join(hourly(c, "known") for c in ("antenna_id", "email", "app"))


@check("metrics_by_dims", f"WITH {DEV}, {DIM}, {KNOWN} {METRICS_SQL}")
def metrics_by_dims(spark: SparkSession, sf: str) -> DataFrame:
    known = joins.enrich(dev(spark, sf), dim(spark, sf))
    return plain_time(metrics.metrics_by_dims(known, ["antenna_id", "email", "app"]))


@check("metrics_beyond_broadcast", f"WITH {DEV}, {DIM}, {KNOWN} {METRICS_SQL}")
def metrics_beyond_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    # The way taken when there are too many users to broadcast.
    config = BatchConfig("", "", FileTable(""), FileTable(""), broadcast_rows=100)
    return plain_time(batch_metrics(dev(spark, sf), dim(spark, sf), config))


@check(
    "enrich_inner",
    f"WITH {DEV}, {DIM} SELECT dev.*, name, email, quota FROM dev JOIN dim USING (id)",
)
def enrich_inner(spark: SparkSession, sf: str) -> DataFrame:
    return joins.enrich(dev(spark, sf), dim(spark, sf), require_unique=True)


@check(
    "enrich_beyond_broadcast",
    f"WITH {DEV}, {DIM} SELECT dev.*, name, email, quota FROM dev JOIN dim USING (id)",
)
def enrich_beyond_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    # The way taken when the dimension is too large to broadcast: hot keys apart.
    return joins.enrich(dev(spark, sf), dim(spark, sf), max_rows=100)


ALERTS = f"""u AS ({hourly('id', 'devt')}),
alerts AS (SELECT email, u.value AS usage, quota, u.timestamp
           FROM u JOIN dim USING (id) WHERE u.value > quota)"""


@check("over_quota", f"WITH {DEV}, {DIM}, {ALERTS} SELECT * FROM alerts")
def over_quota(spark: SparkSession, sf: str) -> DataFrame:
    usage = metrics.metric_by_window(dev(spark, sf), "id")
    return plain_time(joins.over_quota(usage, dim(spark, sf)))


@check(
    "merge_inner",
    """SELECT o_custkey, o_orderkey, o_totalprice, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def merge_inner(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    segments = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.merge_inner(orders, segments, "o_custkey")


@check(
    "distinct_by_window",
    f"""WITH {DEV} SELECT time_bucket(INTERVAL '1 hour', ts) AS timestamp, app,
        count(DISTINCT id) AS value FROM devt GROUP BY 1, 2""",
)
def distinct_by_window(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(metrics.distinct_by_window(dev(spark, sf), ["app"], "id"))


# Exact counts, each with whether the estimate's bounds hold it: days by app, from sketches stored by hour and antenna.
@check(
    "distinct_rollup",
    f"""WITH {DEV} SELECT time_bucket(INTERVAL '1 day', ts) AS timestamp, app, count(DISTINCT id) AS value,
        true AS within FROM devt GROUP BY 1, 2""",
)
def distinct_rollup(spark: SparkSession, sf: str) -> DataFrame:
    stored = LoggedTable(scratch_path(spark, "sketches"))
    for day in range(2):
        part = dev(spark, sf).where(F.floor(F.col("timestamp") / 86400) % 2 == day)
        stored.write(metrics.distinct_sketches(part, ["app", "antenna_id"], "id"), "sketches", day)
    rolled = metrics.roll_up_distinct(stored.read(spark, SKETCHES), ["app"])
    exact = metrics.distinct_by_window(dev(spark, sf), ["app"], "id", "1 day")
    met = exact.join(rolled.withColumnRenamed("value", "estimate"), ["timestamp", "app"])
    within = F.col("value").between(F.col("low"), F.col("high"))
    return plain_time(met.select("timestamp", "app", "value", within.alias("within")))


@check(
    "errors_by_window",
    f"""WITH {DEV} SELECT time_bucket(INTERVAL '1 hour', ts) AS timestamp, antenna_id,
        count(*) FILTER (WHERE app = 'error') AS value FROM devt GROUP BY 1, 2""",
)
def errors_by_window(spark: SparkSession, sf: str) -> DataFrame:
    return plain_time(
        metrics.count_where_by_window(dev(spark, sf), ["antenna_id"], F.col("app") == "error")
    )


@check(
    "category_percent",
    f"""WITH {DEV}, c AS (SELECT id, app, count(*) AS n FROM dev GROUP BY 1, 2)
    SELECT id, app, n, round(n * 100.0 / sum(n) OVER (PARTITION BY id), 6) AS percent FROM c""",
)
def category_percent(spark: SparkSession, sf: str) -> DataFrame:
    shares = metrics.category_percent(dev(spark, sf), "id", "app")
    return shares.withColumn("percent", F.round("percent", 6))


# --- sources and sinks ------------------------------------------------------


@check(
    "json_parse",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_parse(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    # The payload carries its row number so that the rows can be compared.
    payload = events.select(
        F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(", "), F.expr("substring(props, 2)")).alias("value")
    )
    schema = StructType(
        [StructField("event_id", LongType(), False), StructField("k", LongType(), False)]
    )
    return parse_json(payload, schema=schema, bad="drop")


LISTED = "key BIGINT, city STRING, room STRING, neigh STRING, size BIGINT, price DOUBLE, area DOUBLE"


@check("csv_roundtrip", f"WITH {LST} SELECT key, city, room, neigh, size, price, area FROM lst")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "listings")
    lst(spark, sf).toDF("Key", "City", "Room", "Neigh", "Size", "Price", "Area").write.option(
        "sep", ";"
    ).option("header", True).csv(path)
    return read_delimited(spark, path, LISTED, ["key", "city", "room", "neigh", "size", "price", "area"])


@check(
    "csv_text_roundtrip",
    "SELECT doc_id, text, lang FROM documents",
)
def csv_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    # Whole texts with line breaks, quotes and separators inside.
    path = scratch_path(spark, "documents")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.option("sep", ";").option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_delimited(spark, path, "doc_id BIGINT, text STRING, lang STRING", multi_line=True)


@check(
    "csv_multiline_split",
    "SELECT doc_id, text, lang FROM documents",
)
def csv_multiline_split(spark: SparkSession, sf: str) -> DataFrame:
    # The same, with every large file shared by several tasks.
    path = scratch_path(spark, "documents")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.option("sep", ";").option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_delimited(spark, path, "doc_id BIGINT, text STRING, lang STRING", multi_line=True, split=True)


def _land(spark: SparkSession, sf: str, path: str) -> None:
    compact_partitions(with_date_parts(dev(spark, sf)), path)


_LANDED: dict[tuple[str, str], str] = {}


def landed(spark: SparkSession, sf: str) -> str:
    """Where the messages lie by hour; made once for each session."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _LANDED:
        path = scratch_path(spark, "landing")
        _land(spark, sf, path)
        _LANDED[at] = path
    return _LANDED[at]


# The hour of a landed message as a time.
PARTED_HOUR = "make_timestamp(year, month, day, hour, 0, 0)"


def _landed_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return _as_metric(spark.read.schema(LANDED_MESSAGE).parquet(path), kind)


def _as_metric(landed_rows: DataFrame, kind: str) -> DataFrame:
    """Landed messages in the columns of a metric."""
    hour = F.expr("make_timestamp(year, month, day, hour, 0, 0)")
    return landed_rows.select(
        F.lit(kind).alias("kind"),
        F.concat_ws("/", "id", "antenna_id", "app").alias("id"),
        hour.alias("timestamp"),
        F.col("bytes").alias("value"),
    )


HOUR = datetime(2024, 1, 1, 16)
PARTED = """parted AS (SELECT timestamp, id, antenna_id, bytes, app,
  CAST(date_part('year', make_timestamp(timestamp * 1000000)) AS INTEGER) AS year,
  CAST(date_part('month', make_timestamp(timestamp * 1000000)) AS INTEGER) AS month,
  CAST(date_part('day', make_timestamp(timestamp * 1000000)) AS INTEGER) AS day,
  CAST(date_part('hour', make_timestamp(timestamp * 1000000)) AS INTEGER) AS hour FROM dev)"""


@check(
    "read_hour",
    f"WITH {DEV}, {PARTED} SELECT * FROM parted WHERE year = 2024 AND month = 1 AND day = 1 AND hour = 16",
)
def read_one_hour(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    _land(spark, sf, path)
    return read_hour(spark, path, HOUR, LANDED_MESSAGE)


@check(
    "read_hour_elsewhere",
    f"WITH {DEV}, {PARTED} SELECT * FROM parted WHERE year = 2024 AND month = 1 AND day = 1 AND hour = 16",
)
def read_hour_elsewhere(spark: SparkSession, sf: str) -> DataFrame:
    # Landing and reading go by UTC in a session of any zone.
    sent = cut_lineage(dev(spark, sf))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        path = scratch_path(spark, "landing")
        compact_partitions(with_date_parts(sent), path)
        return cut_lineage(read_hour(spark, path, HOUR, LANDED_MESSAGE))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@check("compact_hour", f"WITH {DEV}, {PARTED} SELECT * FROM parted")
def compact_hour(spark: SparkSession, sf: str) -> DataFrame:
    landing, archive = scratch_path(spark, "landing"), scratch_path(spark, "archive")
    _land(spark, sf, landing)
    landed = spark.read.schema(LANDED_MESSAGE).parquet(landing)
    compact_partitions(landed, archive)
    compact_partitions(landed, archive)  # a second run replaces, it adds nothing
    return spark.read.schema(LANDED_MESSAGE).parquet(archive)


@check("table_roundtrip", f"WITH {DEV} {hourly('app', 'devt')}")
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "tables")
    ensure_tables(spark, {"bytes_hourly": METRIC}, root)
    target = FileTable(f"{root}/bytes_hourly")
    for _ in range(2):
        write_table(metrics.metric_by_window(dev(spark, sf), "app"), target, "by_app", "all")
    return plain_time(target.read(spark, METRIC))


# Corrections of some hours: values double, and a row of a new type comes for each.


@check(
    "table_corrections",
    f"""WITH {DEV}, h AS ({hourly('app', 'devt')}),
    fixed AS (SELECT timestamp, id, value * 2 AS value, type FROM h
      WHERE date_part('hour', timestamp) % 3 = 0 AND id <> 'error')
    SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM fixed WHERE fixed.timestamp = h.timestamp AND fixed.id = h.id)
    UNION ALL SELECT * FROM fixed UNION ALL SELECT timestamp, id, value, 'corrected' FROM fixed""",
)
def table_corrections(spark: SparkSession, sf: str) -> DataFrame:
    # Batches of a stream, one of them replayed with other rows; then corrections by key, sent twice.
    out = LoggedTable(scratch_path(spark, "hourly"))
    hourly_rows = cut_lineage(metrics.metric_by_window(dev(spark, sf), "app"), "hourly")
    day = F.floor(F.unix_micros("timestamp") / 86_400_000_000) % 4
    for batch in range(4):
        out.write(hourly_rows.where(day == batch), "by_app", batch)
    out.write(hourly_rows, "by_app", 1)
    wrong = (F.hour("timestamp") % 3 == 0) & (F.col("id") != "error")
    doubled = hourly_rows.where(wrong).withColumn("value", F.col("value") * 2)
    corrected = doubled.unionByName(doubled.withColumn("type", F.lit("corrected")))
    for _ in range(2):
        out.replace_keys(corrected, ["type", "id", "timestamp"], "corrections", 0)
    return plain_time(out.read(spark, METRIC))


@check(
    "load_dimension",
    f"""WITH {DIM} SELECT id, name, email, quota FROM dim
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, lower(replace(c_name, '#', '_')) || '@example.com', 0
    FROM customer WHERE c_acctbal <= 0""",
)
def dimension_loaded(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "user_metadata")
    everyone = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))), F.lit("@example.com")).alias("email"),
        F.lit(0).cast("long").alias("quota"),
    )
    load_dimension(spark, everyone, path)
    load_dimension(spark, dim(spark, sf), path)
    return load_dimension(spark, dim(spark, sf), path)


# --- streams ----------------------------------------------------------------


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """The device messages as a stream of JSON payloads, one row each."""
    path = scratch_path(spark, "messages")
    payload = F.to_json(F.struct(*DEVICE_MESSAGE.fieldNames()))
    dev(spark, sf).repartitionByRange(4, "timestamp").select(payload.alias("value")).write.parquet(path)
    return read_stream(spark, "files", path=path)


def messages_in_turn(spark: SparkSession, sf: str, batches: int = 4, file_rows: int = 100_000) -> DataFrame:
    """The same, in parts that lie one after the other in time and are read one by one.

    All parts have the same number of files, of about ``file_rows`` rows in the smallest part, so that tasks share a part.
    """
    path = scratch_path(spark, "messages")
    payload = F.to_json(F.struct(*DEVICE_MESSAGE.fieldNames()))
    whole = cut_lineage(dev(spark, sf), "messages")
    first, last = whole.agg(F.min("timestamp"), F.max("timestamp")).first()
    part = F.least(F.floor((F.col("timestamp") - first) * batches / (last - first + 1)), F.lit(batches - 1))
    rows = {r["part"]: r["count"] for r in whole.groupBy(part.alias("part")).count().collect()}
    files = max(1, min(rows.get(i, 0) for i in range(batches)) // file_rows)
    for i in range(batches):
        some = whole.where(part == i).select(payload.alias("value"))
        some = some.coalesce(1) if files == 1 else some.repartition(files)
        some.write.mode("append").parquet(path)
    return read_stream(spark, "files", path=path, max_per_trigger=files)


@check("stream_file_source", f"WITH {DEV} SELECT * FROM dev")
def stream_file_source(spark: SparkSession, sf: str) -> DataFrame:
    out = FileTable(scratch_path(spark, "parsed"))
    parsed = parse_json(messages(spark, sf), bad="drop")
    run_queries([sink_table(parsed, out, scratch_path(spark, "checkpoint"), "parsed", available_now=True)])
    return out.read(spark, DEVICE_MESSAGE)


@check(
    "stream_enrich",
    f"WITH {DEV}, {DIM} SELECT dev.*, name, email, quota FROM dev JOIN dim USING (id)",
)
def stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    out = FileTable(scratch_path(spark, "enriched"))
    known = joins.enrich(parse_json(messages(spark, sf), bad="drop"), dim(spark, sf))
    run_queries([sink_table(known, out, scratch_path(spark, "checkpoint"), "enriched", available_now=True)])
    return out.read(spark)


@check("stream_landing", f"WITH {DEV}, {PARTED} SELECT * FROM parted")
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    parsed = parse_json(messages(spark, sf), bad="drop")
    run_queries([sink_landing(parsed, path, scratch_path(spark, "checkpoint"), available_now=True)])
    return spark.read.schema(LANDED_MESSAGE).parquet(path)


@check(
    "stream_metric_2m",
    f"WITH {DEV}, m AS ({hourly('app', 'devt', '2 minutes')}) SELECT * FROM m {CLOSED}",
)
def stream_metric_2m(spark: SparkSession, sf: str) -> DataFrame:
    out = FileTable(scratch_path(spark, "metric"))
    parsed = parse_json(messages(spark, sf), bad="drop")
    metric = metrics.metric_by_window(parsed, "app", "2 minutes", watermark="1 minute")
    run_queries([sink_table(metric, out, scratch_path(spark, "checkpoint"), "by_app", available_now=True)])
    return plain_time(out.read(spark, METRIC))


# The watermark follows the messages of known users, which are the ones aggregated.
CLOSED_KNOWN = """WHERE timestamp + INTERVAL 2 MINUTE <=
  (SELECT max(ts) FROM known) - INTERVAL 1 MINUTE"""
SPEED_SQL = " UNION ALL ".join(hourly(c, "known", "2 minutes") for c in ("antenna_id", "id", "app"))


@check(
    "stream_metric_sink",
    f"WITH {DEV}, {DIM}, {KNOWN}, m AS ({SPEED_SQL}) SELECT * FROM m {CLOSED_KNOWN}",
)
def stream_metric_sink(spark: SparkSession, sf: str) -> DataFrame:
    out = FileTable(scratch_path(spark, "metrics"))
    config = SpeedConfig("", "", out)
    metric = speed_metrics(parse_json(messages(spark, sf), bad="drop"), dim(spark, sf), config)
    run_queries([sink_table(metric, out, scratch_path(spark, "checkpoint"), "speed", available_now=True)])
    return plain_time(out.read(spark, METRIC))


@check(
    "speed_layer",
    f"""WITH {DEV}, {DIM}, {KNOWN}, {PARTED}, m AS ({SPEED_SQL}),
    closed AS (SELECT * FROM m {CLOSED_KNOWN})
    SELECT type AS kind, id, timestamp, value FROM closed
    UNION ALL SELECT 'landed', id || '/' || antenna_id || '/' || app, {PARTED_HOUR}, bytes FROM parted""",
)
def speed_layer(spark: SparkSession, sf: str) -> DataFrame:
    landing, out = scratch_path(spark, "landing"), FileTable(scratch_path(spark, "metrics"))
    config = SpeedConfig(landing, scratch_path(spark, "checkpoints"), out, available_now=True)
    run_speed_layer(messages(spark, sf), dim(spark, sf), config)
    metric = out.read(spark, METRIC).select(F.col("type").alias("kind"), "id", "timestamp", "value")
    return plain_time(metric.unionByName(_landed_rows(spark, landing, "landed")))


@check(
    "speed_layer_single_read",
    f"""WITH {DEV}, {DIM}, {KNOWN}, {PARTED}, m AS ({SPEED_SQL}),
    closed AS (SELECT * FROM m {CLOSED_KNOWN})
    SELECT type AS kind, id, timestamp, value FROM closed
    UNION ALL SELECT 'landed', id || '/' || antenna_id || '/' || app, {PARTED_HOUR}, bytes FROM parted""",
)
def speed_layer_single_read(spark: SparkSession, sf: str) -> DataFrame:
    out = LoggedTable(scratch_path(spark, "metrics"))
    config = SpeedConfig(
        scratch_path(spark, "landing"), scratch_path(spark, "checkpoints"), out, available_now=True
    )
    run_speed_layer_once(messages_in_turn(spark, sf), dim(spark, sf), config)
    metric = out.read(spark, METRIC).select(F.col("type").alias("kind"), "id", "timestamp", "value")
    landed_rows = landing_table(config).read(spark, LANDED_MESSAGE)
    return plain_time(metric.unionByName(_as_metric(landed_rows, "landed")))


@check(
    "compact_stream_table",
    f"WITH {DEV}, m AS ({hourly('app', 'devt', '2 minutes')}) SELECT * FROM m {CLOSED}",
)
def stream_table_compacted(spark: SparkSession, sf: str) -> DataFrame:
    # Micro-batches of two runs are rewritten as one folder; the last one is then replayed.
    out, checkpoint = LoggedTable(scratch_path(spark, "metric")), scratch_path(spark, "checkpoint")
    parsed = parse_json(messages_in_turn(spark, sf), bad="drop")
    metric = metrics.metric_by_window(parsed, "app", "2 minutes", watermark="1 minute")
    run_queries([sink_table(metric, out, checkpoint, "by_app", available_now=True)])
    source, last = next(iter(out.snapshot(spark).last.items()))
    compact_stream_table(spark, out, METRIC)
    for batch in range(last + 1):
        out.write(out.read(spark, METRIC), source, batch)
    return plain_time(out.read(spark, METRIC))


@check(
    "stream_open_windows",
    f"""WITH {DEV}, m AS ({hourly('app', 'devt')}) SELECT timestamp, id, value FROM m
    WHERE timestamp + INTERVAL 1 HOUR > (SELECT max(make_timestamp(timestamp * 1000000)) FROM dev) - INTERVAL 2 DAY""",
)
def stream_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    # What the finished stream still holds, from its checkpoint.
    out, checkpoint = FileTable(scratch_path(spark, "metric")), scratch_path(spark, "checkpoint")
    parsed = parse_json(messages_in_turn(spark, sf), bad="drop")
    metric = metrics.metric_by_window(parsed, "app", "1 hour", watermark="2 days")
    run_queries([sink_table(metric, out, checkpoint, "by_app", available_now=True)])
    return plain_time(open_windows(spark, checkpoint).select("timestamp", "id", F.col("sum").alias("value")))


@check(
    "batch_layer",
    f"""WITH {DEV}, {DIM}, {KNOWN}, {PARTED}, {ALERTS}, m AS ({METRICS_SQL})
    SELECT type AS kind, id, timestamp, value FROM m
    UNION ALL SELECT 'alert', email, timestamp, usage FROM alerts
    UNION ALL SELECT 'archived', id || '/' || antenna_id || '/' || app, {PARTED_HOUR}, bytes FROM parted""",
)
def batch_layer(spark: SparkSession, sf: str) -> DataFrame:
    landing, archive = landed(spark, sf), scratch_path(spark, "archive")
    config = BatchConfig(
        landing, archive, LoggedTable(scratch_path(spark, "bytes_hourly")), LoggedTable(scratch_path(spark, "alerts"))
    )
    times = plain_time(dev(spark, sf).select(F.timestamp_seconds("timestamp").alias("timestamp")))
    first, last = times.agg(F.min("timestamp"), F.max("timestamp")).first()
    first, last = (when.replace(minute=0, second=0, microsecond=0) for when in (first, last))
    run_batch_layer(spark, dim(spark, sf), config, first, last + timedelta(hours=1))
    metric = config.metrics.read(spark, METRIC).select(F.col("type").alias("kind"), "id", "timestamp", "value")
    alert = config.alerts.read(spark, QUOTA_ALERT).select(
        F.lit("alert").alias("kind"), F.col("email").alias("id"), "timestamp", F.col("usage").alias("value")
    )
    kept = _landed_rows(spark, archive, "archived")
    return plain_time(metric.unionByName(alert).unionByName(kept))


# Three hours; the first is run again alone, then once more in another time zone.
SOME_HOURS = "timestamp >= TIMESTAMP '2024-01-01 16:00:00' AND timestamp < TIMESTAMP '2024-01-01 19:00:00'"


@check(
    "batch_rerun_overlap",
    f"""WITH {DEV}, {DIM}, {KNOWN}, {ALERTS}, m AS ({METRICS_SQL})
    SELECT type AS kind, id, timestamp, value FROM m WHERE {SOME_HOURS}
    UNION ALL SELECT 'alert', email, timestamp, usage FROM alerts WHERE {SOME_HOURS}""",
)
def batch_rerun_overlap(spark: SparkSession, sf: str) -> DataFrame:
    landing = landed(spark, sf)
    config = BatchConfig(
        landing,
        scratch_path(spark, "archive"),
        FileTable(scratch_path(spark, "bytes_hourly")),
        FileTable(scratch_path(spark, "alerts")),
    )
    users = dim(spark, sf)
    run_batch_layer(spark, users, config, HOUR, HOUR + timedelta(hours=3))
    run_batch_layer(spark, users, config, HOUR)
    elsewhere = (HOUR + timedelta(hours=1)).replace(tzinfo=timezone(timedelta(hours=1)))
    run_batch_layer(spark, users, config, elsewhere)
    metric = config.metrics.read(spark, METRIC).select(F.col("type").alias("kind"), "id", "timestamp", "value")
    alert = config.alerts.read(spark, QUOTA_ALERT).select(
        F.lit("alert").alias("kind"), F.col("email").alias("id"), "timestamp", F.col("usage").alias("value")
    )
    return plain_time(metric.unionByName(alert))


@check("stream_new_checkpoint", f"WITH {DEV} SELECT * FROM dev UNION ALL SELECT * FROM dev")
def stream_new_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    # Two queries of one name, each with a checkpoint of its own, add to one table.
    out = FileTable(scratch_path(spark, "parsed"))
    for _ in range(2):
        parsed = parse_json(messages(spark, sf), bad="drop")
        run_queries([sink_table(parsed, out, scratch_path(spark, "checkpoint"), "parsed", available_now=True)])
    return out.read(spark, DEVICE_MESSAGE)
