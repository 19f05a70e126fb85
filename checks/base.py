"""Registry of checked queries and the views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; without ``sql`` only its own test covers it."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Times without a zone, as DuckDB's TIMESTAMP."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


# Device messages from the event stream.
DEV = """dev AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, CAST(user_id AS VARCHAR) AS id,
         'A' || CAST(user_id % 7 AS VARCHAR) AS antenna_id,
         CAST(round(value * 100) AS BIGINT) AS bytes, event_type AS app
  FROM events),
devt AS (SELECT make_timestamp(timestamp * 1000000) AS ts, id, antenna_id, bytes, app FROM dev)"""


def dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").cast("long").alias("timestamp"),
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string")).alias("antenna_id"),
        F.round(F.col("value") * 100).cast("long").alias("bytes"),
        F.col("event_type").alias("app"),
    )


# User metadata: customers in credit have a quota, the others are unknown users.
DIM = """dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         lower(replace(c_name, '#', '_')) || '@example.com' AS email,
         CAST(round(c_acctbal * 100) AS BIGINT) AS quota
  FROM customer WHERE c_acctbal > 0)"""


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal > 0")
        .select(
            F.col("c_custkey").cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.concat(
                F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))), F.lit("@example.com")
            ).alias("email"),
            F.round(F.col("c_acctbal") * 100).cast("long").alias("quota"),
        )
    )


# Listings from the parts; the area depends on the neighbourhood.
LST = """lst AS (
  SELECT p_partkey AS key, p_brand AS city, p_type AS room,
         'N' || CAST((p_partkey % 1000) // 100 AS VARCHAR) AS neigh,
         CAST(p_size AS BIGINT) AS size, p_retailprice AS price,
         CAST(((p_partkey % 1000) // 100 // 2) * 50 + p_size AS DOUBLE) AS area
  FROM part)"""


def lst(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundred = F.floor((F.col("p_partkey") % 1000) / 100).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"),
        F.col("p_brand").alias("city"),
        F.col("p_type").alias("room"),
        F.concat(F.lit("N"), hundred.cast("string")).alias("neigh"),
        F.col("p_size").cast("long").alias("size"),
        F.col("p_retailprice").alias("price"),
        (F.floor(hundred / 2) * 50 + F.col("p_size")).cast("double").alias("area"),
    )


# Listings whose smallest areas are unknown, one neighbourhood entirely.
GAP = """gap AS (
  SELECT key, city, room, neigh, size, price,
         CASE WHEN size >= 20 AND neigh <> 'N1' THEN area END AS area
  FROM lst)"""


def gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = (F.col("size") >= 20) & (F.col("neigh") != "N1")
    return lst(spark, sf_dir).withColumn("area", F.when(known, F.col("area")))


# Documents with their labels, unknown for most.
LAB = """lab AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


# Order lines as points with six measures; the key columns make a row unique.
PTS = """pts AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS key,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
         CAST(l_linenumber AS DOUBLE) AS line,
         CAST(floor(epoch(l_shipdate) / 86400) AS DOUBLE) AS shipped, l_partkey AS part
  FROM lineitem)"""
MEASURES = ["quantity", "price", "discount", "tax", "line", "shipped"]


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.floor(F.col("l_shipdate").cast("timestamp").cast("long") / 86400).cast("double").alias("shipped"),
        F.col("l_partkey").alias("part"),
    )


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})
