from __future__ import annotations

import json
import time
from datetime import datetime, timedelta, timezone

import pytest

from tidemark.operators.joins import enrich
from tidemark.operators.metrics import metric_by_window, metrics_by_dims
from tidemark.plans.batch import BatchConfig, run_batch_layer
from tidemark.plans.speed import SpeedConfig, run_speed_layer
from tidemark.schemas import DEVICE_MESSAGE, LANDED_MESSAGE, METRIC, QUOTA_ALERT
from tidemark.sources.readers import parse_json, read_stream
from tidemark.sources.sinks import FileTable
from tidemark.streaming.queries import run_queries, sink_landing, sink_table

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(clock, bytes_, user="u", antenna="A1", app="web"):
    hours, minutes, seconds = map(int, clock.split(":"))
    at = START + timedelta(hours=hours, minutes=minutes, seconds=seconds)
    return json.dumps(
        {"timestamp": int(at.timestamp()), "id": user, "antenna_id": antenna, "bytes": bytes_, "app": app}
    )


class Feed:
    """A folder that receives one text file of messages after the other."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        path.mkdir()

    def add(self, *messages):
        self.files += 1
        (self.path / f"{self.files:03d}.txt").write_text("\n".join(messages) + "\n")
        time.sleep(0.02)  # files are read in the order of their times

    def stream(self):
        return read_stream(self.spark, "files", path=str(self.path), format="text", max_per_trigger=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [("u", "Una", "una@x", 10), ("v", "Vic", "vic@x", 1000)], "id string, name string, email string, quota long"
    )


def windows(table, spark):
    found = table.read(spark, METRIC).orderBy("timestamp", "type", "id").collect()
    return [(f"{r.timestamp:%H:%M}", r.type, r.id, r.value) for r in found]


def run_metric(spark, feed, tmp_path, name="metric"):
    out = FileTable(str(tmp_path / name))
    metric = metric_by_window(parse_json(feed.stream(), bad="drop"), "app", "2 minutes", watermark="1 minute")
    run_queries([sink_table(metric, out, str(tmp_path / f"{name}-checkpoint"), name, available_now=True)])
    return out


def test_late_rows(spark, feed, tmp_path):
    feed.add(message("00:00:30", 1))
    feed.add(message("00:10:00", 1))
    # Still counted: the first window is closed by this very batch.
    feed.add(message("00:00:40", 1), message("00:09:30", 5))
    # Too late: the watermark of 00:09 has passed this window.
    feed.add(message("00:00:50", 100))
    feed.add(message("01:00:00", 1))
    assert [(w, v) for w, _, _, v in windows(run_metric(spark, feed, tmp_path), spark)] == [
        ("00:00", 2),
        ("00:08", 5),
        ("00:10", 1),
    ]


def test_restart_neither_loses_nor_repeats(spark, feed, tmp_path):
    feed.add(message("00:00:30", 1), message("00:02:10", 10))
    feed.add(message("00:05:00", 100))
    assert len(windows(run_metric(spark, feed, tmp_path), spark)) == 2
    feed.add(message("00:05:30", 1000))  # joins the window left open by the first run
    feed.add(message("00:30:00", 1))
    out = run_metric(spark, feed, tmp_path)
    run_metric(spark, feed, tmp_path)  # nothing new
    assert [(w, v) for w, _, _, v in windows(out, spark)] == [("00:00", 1), ("00:02", 10), ("00:04", 1100)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    out = FileTable(str(tmp_path / "t"))
    first = spark.createDataFrame([("a",)], "x string")
    for batch, source in ((0, "q"), (1, "q"), (1, "q"), (1, "other")):
        out.write(first, source, batch)
    assert out.read(spark).count() == 3


def test_landing_is_exact_over_restarts(spark, feed, tmp_path):
    path = str(tmp_path / "landing")

    def land():
        parsed = parse_json(feed.stream(), bad="drop")
        run_queries([sink_landing(parsed, path, str(tmp_path / "checkpoint"), available_now=True)])
        return spark.read.schema(LANDED_MESSAGE).parquet(path)

    feed.add(message("00:59:59", 1), message("01:00:00", 2))
    assert land().count() == 2
    feed.add(message("23:00:00", 3))
    found = land()
    assert {(r.day, r.hour, r.bytes) for r in found.collect()} == {(1, 0, 1), (1, 1, 2), (1, 23, 3)}
    assert land().count() == 3


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_stream_enrichment_small_and_large_dimension(spark, feed, users, tmp_path, max_rows):
    feed.add(message("00:00:01", 1, "u"), message("00:00:02", 2, "nobody"), message("00:00:03", 3, "v"))
    out = FileTable(str(tmp_path / "out"))
    known = enrich(parse_json(feed.stream(), bad="drop"), users, max_rows=max_rows)
    run_queries([sink_table(known, out, str(tmp_path / "checkpoint"), "known", available_now=True)])
    found = out.read(spark)
    assert "_salt" not in found.columns
    assert {(r.bytes, r.email) for r in found.collect()} == {(1, "una@x"), (3, "vic@x")}


def test_one_query_for_all_dimensions_equals_one_for_each(spark, feed, tmp_path):
    feed.add(*[message(f"00:{i:02d}:00", i, f"u{i % 3}", f"A{i % 2}", f"app{i % 4}") for i in range(30)])
    feed.add(message("02:00:00", 1))
    parsed = parse_json(feed.stream(), bad="drop")
    dims = ["antenna_id", "id", "app"]
    together, apart = FileTable(str(tmp_path / "together")), FileTable(str(tmp_path / "apart"))
    starts = [
        sink_table(
            metrics_by_dims(parsed, dims, "2 minutes", "1 minute"),
            together, str(tmp_path / "c"), "together", available_now=True,
        )
    ] + [
        sink_table(
            metric_by_window(parsed, dim, "2 minutes", "1 minute"),
            apart, str(tmp_path / f"c-{dim}"), dim, available_now=True,
        )
        for dim in dims
    ]
    run_queries(starts)
    assert windows(together, spark) == windows(apart, spark) and len(windows(apart, spark)) > 60


def test_failure_stops_the_other_queries(spark, feed, tmp_path):
    feed.add(message("00:00:01", 1))
    parsed = parse_json(feed.stream(), bad="drop")

    class Broken:
        def write(self, df, source, batch):
            raise RuntimeError("target is gone")

    endless = sink_table(parsed, FileTable(str(tmp_path / "fine")), str(tmp_path / "c1"), "endless", every="1 second")
    broken = sink_table(parsed, Broken(), str(tmp_path / "c2"), "broken", available_now=True)
    with pytest.raises(Exception, match="target is gone"):
        run_queries([endless, broken])
    assert not spark.streams.active


def test_metric_sink_needs_a_checkpoint(spark, feed):
    with pytest.raises(ValueError, match="needs a checkpoint"):
        sink_table(feed.stream(), FileTable("x"), "", "q")


def test_speed_and_batch_layers(spark, feed, users, tmp_path):
    feed.add(message("16:00:10", 8, "u"), message("16:00:20", 4, "u", "A2"), "not json")
    feed.add(message("16:30:00", 7, "nobody"), message("16:59:59", 9, "v", "A2", "mail"))
    feed.add(message("17:10:00", 500, "u"))
    at = lambda name: str(tmp_path / name)
    speed = SpeedConfig(
        at("landing"), at("checkpoints"), FileTable(at("bytes")), rejected=FileTable(at("rejected")), available_now=True
    )
    run_speed_layer(feed.stream(), users, speed)
    assert FileTable(at("rejected")).read(spark).collect() == [("not json",)]
    assert spark.read.parquet(at("landing")).count() == 5  # also the unknown user's message
    assert windows(speed.metrics, spark) == [
        ("16:00", "antenna_id_total_bytes", "A1", 8),
        ("16:00", "antenna_id_total_bytes", "A2", 4),
        ("16:00", "app_total_bytes", "web", 12),
        ("16:00", "id_total_bytes", "u", 12),
        ("16:58", "antenna_id_total_bytes", "A2", 9),
        ("16:58", "app_total_bytes", "mail", 9),
        ("16:58", "id_total_bytes", "v", 9),
    ]
    batch = BatchConfig(at("landing"), at("archive"), FileTable(at("hourly")), FileTable(at("alerts")))
    for _ in range(2):
        run_batch_layer(spark, users, batch, datetime(2024, 1, 1, 16, tzinfo=timezone.utc))
    assert windows(batch.metrics, spark) == [
        ("16:00", "antenna_id_total_bytes", "A1", 8),
        ("16:00", "antenna_id_total_bytes", "A2", 13),
        ("16:00", "app_total_bytes", "mail", 9),
        ("16:00", "app_total_bytes", "web", 12),
        ("16:00", "email_total_bytes", "una@x", 12),
        ("16:00", "email_total_bytes", "vic@x", 9),
    ]
    alerts = batch.alerts.read(spark, QUOTA_ALERT).collect()
    assert [tuple(r) for r in alerts] == [("una@x", 12, 10, datetime(2024, 1, 1, 16))]
    archived = spark.read.schema(LANDED_MESSAGE).parquet(at("archive"))
    assert archived.count() == 4 and {r.hour for r in archived.collect()} == {16}
    assert set(DEVICE_MESSAGE.fieldNames()) < set(archived.columns)
