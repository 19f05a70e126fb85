from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.base import dev
from tidemark.functions.scalar import with_date_parts
from tidemark.operators.metrics import metric_by_window
from tidemark.schemas import DEVICE_MESSAGE, LANDED_MESSAGE, METRIC, QUOTA_ALERT, USER_METADATA
from tidemark.sources import readers, sinks

PAYLOADS = [
    ('{"timestamp":1,"id":"u","antenna_id":"a","bytes":5,"app":"x"}', True),
    ('{"timestamp":2,"id":"u","antenna_id":"a","bytes":5,"app":"x","more":1}', True),
    ("no json", False),
    ('{"timestamp":3,"id":"u","antenna_id":"a","app":"x"}', False),
    ('{"timestamp":"late","id":"u","antenna_id":"a","bytes":5,"app":"x"}', False),
    (None, False),
]


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_parse_json(spark, kind):
    df = spark.createDataFrame([(p,) for p, _ in PAYLOADS], "value string").select(F.col("value").cast(kind))
    assert readers.parse_json(df).count() == 6
    assert readers.parse_json(df).where("bytes IS NULL AND id IS NULL").count() == 2
    good = readers.parse_json(df, bad="drop")
    assert good.columns == DEVICE_MESSAGE.fieldNames()
    assert sorted(r.timestamp for r in good.collect()) == [1, 2]
    kept, rejected = readers.parse_json(df, bad="split")
    assert kept.count() == 2
    assert [r.payload for r in rejected.collect()] == [p for p, fine in PAYLOADS if not fine]
    with pytest.raises(ValueError):
        readers.parse_json(df, bad="ignore")


def test_kafka_options():
    assert readers.kafka_options("h:9092", "devices") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "devices",
    }
    options = readers.kafka_options("h:9092", "devices", "earliest", 1000, 64)
    assert options["minPartitions"] == "64"
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError, match="unknown stream kind"):
        readers.read_stream(spark, "carrier pigeon")


def test_jdbc_options():
    jdbc = {"url": "jdbc:postgresql://host/db", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    plain = readers.jdbc_read_options(jdbc, "user_metadata")
    assert plain == {**jdbc, "dbtable": "user_metadata", "fetchsize": "10000"}
    split = readers.jdbc_read_options(jdbc, "user_metadata", ("id", 0, 100, 4))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "100", "4",
    )
    assert sinks.JdbcTable(jdbc, "bytes").options()["dbtable"] == "bytes"


def test_jdbc_rows_carry_their_batch(spark):
    df = spark.range(2)
    assert sinks.JdbcTable({}, "t").rows(df, "q", 3).columns == ["id"]
    tagged = sinks.JdbcTable({}, "t", tag=True).rows(df, "q", 3)
    assert tagged.collect() == [(0, "q", "3"), (1, "q", "3")]


CSV = '''Room.Type;Neighbourhood;Square.Feet;Price;Note
Entire home/apt;Sol;500;80;plain
Entire home/apt;;NA;81;NA
Entire home/apt;"";;82;"with ; and
a break and ""quotes"""
'''


def test_read_delimited(spark, tmp_path):
    (tmp_path / "listings.csv").write_text(CSV)
    schema = "a string, b string, square_feet double, price double, note string"
    df = readers.read_delimited(spark, str(tmp_path), schema.replace("a string, b", "room_type string, neighbourhood"), multi_line=True)
    found = df.orderBy("price").collect()
    assert df.columns == ["room_type", "neighbourhood", "square_feet", "price", "note"]
    assert [r.square_feet for r in found] == [500.0, None, None]
    assert [r.neighbourhood or None for r in found] == ["Sol", None, None]
    assert [r.note for r in found] == ["plain", None, 'with ; and\na break and "quotes"']
    inferred = readers.read_delimited(spark, str(tmp_path), columns=["price", "room_type"], multi_line=True)
    assert inferred.columns == ["price", "room_type"] and dict(inferred.dtypes)["price"] == "int"


def test_snake_case():
    assert [readers.snake_case(n) for n in ("Room.Type", "Square Feet", " City ", "Review.Scores.Rating")] == [
        "room_type", "square_feet", "city", "review_scores_rating",
    ]


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "data")
    sinks.compact_partitions(with_date_parts(dev(spark, sf)), path)
    return path


def test_read_hour_reads_one_directory(spark, landing):
    when = datetime(2024, 1, 2, 17, 30, tzinfo=timezone(timedelta(hours=1)))
    df = readers.read_hour(spark, landing, when, LANDED_MESSAGE)
    assert df.inputFiles() and all("month=1/day=2/hour=16" in f for f in _selected(df))
    assert {(r.day, r.hour) for r in df.collect()} == {(2, 16)}


def _selected(df):
    """Files read; no other hour is even listed."""
    assert all(re.search("day=(2/hour=(16|22|23)|3/hour=[01])/", f) for f in df.inputFiles())
    return [r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()]


def test_read_hours_covers_days(spark, landing):
    df = readers.read_hours(spark, landing, datetime(2024, 1, 2, 22), datetime(2024, 1, 3, 1, 1), LANDED_MESSAGE)
    assert _selected(df)
    assert {(r.day, r.hour) for r in df.collect()} == {(2, 22), (2, 23), (3, 0), (3, 1)}


def test_compaction_gives_one_file_for_a_small_hour(spark, landing, tmp_path):
    many = spark.read.schema(LANDED_MESSAGE).parquet(landing).where("day <= 2").repartition(6)
    path = str(tmp_path / "archive")
    for _ in range(2):
        sinks.compact_partitions(many, path)
    files = list(Path(path).rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 48
    assert spark.read.parquet(path).count() == many.count()


def test_compaction_replaces_only_its_partitions(spark, landing, tmp_path):
    path = str(tmp_path / "archive")
    landed = spark.read.schema(LANDED_MESSAGE).parquet(landing)
    sinks.compact_partitions(landed.where("day = 1"), path)
    sinks.compact_partitions(landed.where("day = 2"), path)
    sinks.compact_partitions(landed.where("day = 2"), path)
    assert spark.read.parquet(path).count() == landed.where("day <= 2").count()


def test_compaction_splits_a_large_hour(spark, tmp_path):
    big = spark.range(400_000).select(
        F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"), F.lit(1).alias("hour")
    )
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "500k")
    try:
        sinks.compact_partitions(big.repartition(16), str(tmp_path / "archive"), ["hour"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(list((tmp_path / "archive").rglob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 400_000


def test_load_dimension_replaces_by_key(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = spark.createDataFrame([("1", "a", "a@x", 5), ("2", "b", "b@x", 6)], USER_METADATA)
    second = spark.createDataFrame([("2", "b", "b@x", 60), ("3", "c", "c@x", 7)], USER_METADATA)
    for df in (first, first, second, second):
        table = sinks.load_dimension(spark, df, path)
    assert {r.id: r.quota for r in table.collect()} == {"1": 5, "2": 60, "3": 7}
    assert table.count() == 3 and table.columns == USER_METADATA.fieldNames()


def test_load_dimension_refuses_double_keys(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "a@x", 5), ("1", "b", "b@x", 6)], USER_METADATA)
    with pytest.raises(ValueError, match="occurs 2 times"):
        sinks.load_dimension(spark, df, str(tmp_path / "dim"))


def test_ensure_tables_keeps_what_is_there(spark, tmp_path):
    tables = {"bytes_hourly": METRIC, "user_quota_limit": QUOTA_ALERT}
    sinks.ensure_tables(spark, tables, str(tmp_path))
    target = sinks.FileTable(f"{tmp_path}/bytes_hourly")
    assert target.read(spark).count() == 0 and target.read(spark, METRIC).schema == METRIC
    messages = spark.createDataFrame([(3600, "u", "a", 5, "x"), (3601, "u", "a", 6, "x")], DEVICE_MESSAGE)
    for _ in range(2):
        sinks.write_table(metric_by_window(messages, "id"), target, "by_id", 0)
    sinks.ensure_tables(spark, tables, str(tmp_path))
    assert target.read(spark, METRIC).collect() == [(datetime(1970, 1, 1, 1), "u", 11, "id_total_bytes")]


JDBC = {"url": "jdbc:postgresql://nowhere/db", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}


@pytest.mark.parametrize(
    "use",
    [
        lambda spark, df: readers.read_dimension(spark, JDBC, "user_metadata"),
        lambda spark, df: sinks.write_table(df, sinks.JdbcTable(JDBC, "bytes"), "q", 0),
        lambda spark, df: sinks.ensure_jdbc_tables(spark, {"bytes": METRIC}, JDBC),
        lambda spark, df: sinks.load_jdbc_dimension(spark, df, JDBC, "user_metadata"),
    ],
)
def test_jdbc_asks_for_its_driver(spark, use):
    # As far as a database can be approached without one.
    df = spark.createDataFrame([("1", "a", "a@x", 5)], USER_METADATA)
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        use(spark, df)


def test_kafka_asks_for_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        readers.read_stream(spark, "kafka", servers="nowhere:9092", topic="devices")


@pytest.mark.parametrize("size", ["50", "400", "64m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_one_file_are_read_by_many_tasks(spark, tmp_path, size, end):
    """Blocks of any size: records and line breaks at their borders, records over many blocks, doubled quotes, empty lines."""
    draw = random.Random(3)
    words = ['say ""hi""', "a;b", "x", "", "é", "two\nlines", "three\n\nlines\n", '""', "\n" * 5, "long " * 60]
    lines = ["Key;Some.Text;Number"]
    for i in range(50):
        text = draw.choice(words) + draw.choice(words)
        lines.append(f'{i};"{text}";{draw.choice(["1.5", "NA", "2"])}' if draw.random() < 0.7 else f"{i};plain {i};{i}.25")
        if draw.random() < 0.05:
            lines.append("")
    folder = tmp_path / "csv"
    folder.mkdir()
    for name in ("a", "b"):
        (folder / f"{name}.csv").write_bytes((end.join(lines) + (end if name == "a" else "")).encode())
    (folder / "c.csv").write_bytes(b"Key;Some.Text;Number")
    schema = "key int, some_text string, number double"
    want = readers.read_delimited(spark, str(folder), schema, multi_line=True).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records = readers.read_records(spark, str(folder))
        found = readers.read_delimited(spark, str(folder), schema, multi_line=True, split=True).collect()
        lines_read = readers._lines(spark, str(folder), '"')
        if size != "64m":
            assert lines_read.rdd.getNumPartitions() > 6
        assert records.where("first").count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    key = lambda r: (r.key, r.some_text or "", r.number or 0)
    assert sorted(found, key=key) == sorted(want, key=key) and len(found) == 100


def test_splitting_without_a_broadcast_and_without_a_schema(spark, tmp_path, monkeypatch):
    path = tmp_path / "one.csv"
    path.write_text("a;b\n" + "".join(f'{i};"x\n{i}"\n' for i in range(40)))
    monkeypatch.setattr(readers, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        found = readers.read_delimited(spark, str(path), "a int, b string", multi_line=True, split=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, found)) == [(i, f"x\n{i}") for i in range(40)]
    with pytest.raises(ValueError, match="needs a schema"):
        readers.read_delimited(spark, str(path), split=True)
