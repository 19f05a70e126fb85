"""The jobs as programs, for ``spark-submit``.

    provision  create the tables and load the users from separated text
    speed      run the speed layer on a Kafka topic or on a folder of text files
    batch      run the batch layer for one hour or several
    compact    rewrite the small folders of a logged table and delete what is long removed

Tables live under ``--tables``, or in the database that TIDEMARK_JDBC_URL, _USER,
_PASSWORD and _DRIVER describe.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.batch import BatchConfig, run_batch_layer
from tidemark.plans.speed import SpeedConfig, run_speed_layer, run_speed_layer_once
from tidemark.schemas import DATE_PARTS, LANDED_MESSAGE, METRIC, QUOTA_ALERT, USER_METADATA
from tidemark.sources.logged import LoggedTable, compact_stream_table
from tidemark.sources.readers import read_delimited, read_dimension, read_stream
from tidemark.sources.sinks import (
    FileTable,
    JdbcTable,
    Table,
    ensure_jdbc_tables,
    ensure_tables,
    load_dimension,
    load_jdbc_dimension,
    read_dimension_table,
)

RESULTS = {"bytes": METRIC, "bytes_hourly": METRIC, "user_quota_limit": QUOTA_ALERT}
USERS = "user_metadata"
LOGGED = "bytes_logged"


def jdbc_settings() -> dict[str, str]:
    names = ("url", "user", "password", "driver")
    found = {name: os.environ.get(f"TIDEMARK_JDBC_{name.upper()}") for name in names}
    missing = [f"TIDEMARK_JDBC_{name.upper()}" for name, value in found.items() if not value]
    if missing:
        raise ValueError(f"give --tables or set {', '.join(missing)}")
    return found


def _table(args: argparse.Namespace, name: str) -> Table:
    return FileTable(f"{args.tables}/{name}") if args.tables else JdbcTable(jdbc_settings(), name)


def _users(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.tables:
        return read_dimension_table(spark, f"{args.tables}/{USERS}")
    return read_dimension(spark, jdbc_settings(), USERS)


def provision(spark: SparkSession, args: argparse.Namespace) -> None:
    users = read_delimited(spark, args.users, USER_METADATA, separator=args.separator)
    if args.tables:
        ensure_tables(spark, RESULTS, args.tables)
        load_dimension(spark, users, f"{args.tables}/{USERS}")
    else:
        ensure_jdbc_tables(spark, {**RESULTS, USERS: USER_METADATA}, jdbc_settings())
        load_jdbc_dimension(spark, users, jdbc_settings(), USERS)


def speed(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.single_read and not args.tables:
        raise ValueError("--single-read needs --tables")
    if args.servers:
        source = read_stream(spark, "kafka", servers=args.servers, topic=args.topic)
    else:
        source = read_stream(spark, "files", path=args.files, format="text")
    config = SpeedConfig(
        landing=args.landing,
        checkpoints=args.checkpoints,
        metrics=LoggedTable(f"{args.tables}/{LOGGED}") if args.single_read else _table(args, "bytes"),
        rejected=FileTable(args.rejected) if args.rejected else None,
        window=args.window,
        watermark=args.watermark,
        available_now=args.once,
    )
    run = run_speed_layer_once if args.single_read else run_speed_layer
    run(source, _users(spark, args), config)


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    config = BatchConfig(
        landing=args.landing,
        archive=args.archive,
        metrics=_table(args, "bytes_hourly"),
        alerts=_table(args, "user_quota_limit"),
    )
    end = args.hour + timedelta(hours=args.hours)
    run_batch_layer(spark, _users(spark, args), config, args.hour, end)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """The landing of a single-read layer, and its metrics where the tables are named."""
    tables = [(LoggedTable(args.landing, "timestamp", DATE_PARTS), LANDED_MESSAGE)] if args.landing else []
    if args.tables:
        tables.append((LoggedTable(f"{args.tables}/{LOGGED}"), METRIC))
    for table, schema in tables:
        compact_stream_table(spark, table, schema)
        table.vacuum(spark, args.keep_days * 86400)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("provision")
    job.add_argument("--users", required=True, help="separated text: id, name, email, quota")
    job.add_argument("--separator", default=";")
    job.set_defaults(run=provision)

    job = jobs.add_parser("speed")
    origin = job.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers", help="Kafka servers")
    origin.add_argument("--files", help="folder of text files, one message a line")
    job.add_argument("--topic", default="devices")
    job.add_argument("--landing", required=True)
    job.add_argument("--checkpoints", required=True)
    job.add_argument("--rejected", help="folder for malformed payloads")
    job.add_argument("--window", default="2 minutes")
    job.add_argument("--watermark", default="1 minute")
    job.add_argument("--single-read", action="store_true", help="one query; landing and metrics are logged tables")
    job.add_argument("--once", action="store_true", help="process what is there and end")
    job.set_defaults(run=speed)

    job = jobs.add_parser("batch")
    job.add_argument("--landing", required=True)
    job.add_argument("--archive", required=True)
    job.add_argument("--hour", required=True, type=datetime.fromisoformat, help="2024-01-31T16:00:00Z")
    job.add_argument("--hours", type=int, default=1)
    job.set_defaults(run=batch)

    job = jobs.add_parser("compact")
    job.add_argument("--landing", help="landing of a single-read layer")
    job.add_argument("--keep-days", type=float, default=7.0)
    job.set_defaults(run=compact)

    for job in jobs.choices.values():
        job.add_argument("--tables", help="folder of the tables; a database otherwise")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    args.run(spark, args)


if __name__ == "__main__":
    main()
