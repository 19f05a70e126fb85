from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import metrics, profile, rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("a", "x", 0.0), ("a", "y", 2.0), ("b", "x", None), (None, "y", 1.0), ("b", None, 0.0)],
        "g string, h string, v double",
    )


def test_shares(df):
    shares = {r.column: r.percent for r in profile.null_share(df, ["g", "h", "v"]).collect()}
    assert shares == {"g": 20.0, "h": 20.0, "v": 20.0}
    assert profile.value_share(df, "v", 0.0).first().share == 0.5
    assert profile.value_share(df, "v", 0.0, percent=True).first().share == 50.0


def test_frequencies(df):
    assert {tuple(r) for r in profile.freq(df, "g").collect()} == {("a", 2), ("b", 2)}
    assert {tuple(r) for r in profile.nonnull_by_group(df, "g", "v").collect()} == {("a", 2), ("b", 1), (None, 1)}
    assert [r.g for r in profile.distinct_sorted(df, "g").collect()] == ["a", "b"]


def test_contingency(df):
    cells = {tuple(r) for r in profile.contingency(df, "g", "h").collect()}
    assert cells == {("a", "x", 1), ("a", "y", 1), ("b", "x", 1), ("b", "y", 0)}
    assert ("b", "y", 0) not in {tuple(r) for r in profile.contingency(df, "g", "h", zeros=False).collect()}


def test_contingency_of_very_many_values(spark):
    wide = spark.range(12_000).select((F.col("id") % 2).alias("g"), "id")
    cells = profile.contingency(wide, "g", "id")
    assert cells.agg(F.count("*"), F.sum("n")).first() == (24_000, 12_000)
    assert "Literal" not in cells._jdf.queryExecution().toString()


def test_share_of_a_column_without_values(spark):
    nothing = spark.createDataFrame([(None,), (None,)], "v double")
    assert profile.value_share(nothing, "v", 0).first()[0] is None


@pytest.mark.parametrize(
    "low,high,bins,step",
    [(0, 100, 20, 5), (0, 1, 20, 0.05), (0, 37, 20, 2), (-3, 3, 20, 0.5), (0, 1000, 3, 500), (0, 75, 10, 10)],
)
def test_pretty_step(low, high, bins, step):
    assert profile.pretty_step(low, high, bins) == pytest.approx(step)


def test_histogram_is_closed_on_the_right(spark):
    values = [0.0, 0.1, 0.2, 0.25, 0.3, 1.0, float("nan"), float("inf"), None]
    found = profile.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 10).orderBy("bin").collect()
    assert [r.n for r in found] == [2, 1, 2, 0, 0, 0, 0, 0, 0, 1]
    assert found[0].low == 0.0 and found[-1].high == pytest.approx(1.0)


def test_histogram_of_one_value_and_of_none(spark):
    assert profile.histogram(spark.createDataFrame([(2.0,)] * 3, "x double"), "x").collect() == [(1, 2.0, 2.0, 3)]
    assert profile.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


def test_rows(df):
    assert rows.keep_equal(df, {"g": "a", "h": "x"}).count() == 1
    assert rows.drop_incomplete(df).count() == 2 and rows.drop_incomplete(df, ["g"]).count() == 4
    assert [r.v for r in rows.head_n(df.where("v IS NOT NULL"), 2, [F.desc("v")]).collect()] == [2.0, 1.0]


def test_units_round_half_up(spark):
    meters = scalar.convert_units(F.lit(5000.0), scalar.SQUARE_METERS_PER_SQUARE_FOOT)
    assert spark.range(1).select(meters.alias("m")).first().m == 464.52


def test_null_when_keeps_unknown(df):
    v = F.col("v")
    found = df.select(scalar.null_when(v, v == 0).alias("v"), scalar.null_when(v, v < 2).alias("w")).collect()
    assert [r.v for r in found] == [None, 2.0, None, 1.0, None]
    assert [r.w for r in found] == [None, 2.0, None, None, None]


def test_category_percent(df):
    found = {(r.g, r.h): r.percent for r in metrics.category_percent(df, "g", "h").collect()}
    assert found == {("a", "x"): 50.0, ("a", "y"): 50.0, ("b", "x"): 50.0, ("b", None): 50.0, (None, "y"): 100.0}


def test_windows_of_both_time_forms(spark):
    epoch = spark.createDataFrame([(3599, "a", 1), (3600, "a", 2), (7199, "a", 4)], "timestamp long, id string, bytes long")
    clock = epoch.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    for df in (epoch, clock, clock.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))):
        found = metrics.metric_by_window(df, "id").orderBy("timestamp").collect()
        assert [(r.timestamp.hour, r.value) for r in found] == [(0, 1), (1, 6)]


def test_distinct_exact_and_approximate(spark):
    df = spark.range(2000).select(F.lit(0).cast("long").alias("timestamp"), F.lit("k").alias("k"), (F.col("id") % 500).alias("u"))
    assert metrics.distinct_by_window(df, ["k"], "u").first().value == 500
    assert math.isclose(metrics.distinct_by_window(df, ["k"], "u", approx=True).first().value, 500, rel_tol=0.15)


def test_distinct_counts_roll_up(spark):
    """Sketches by hour and key merge to days and over keys; shared values count once, unknown ones not at all."""
    hour = 3600
    rows = [(h * hour, k, f"v{(h * 500 + i) % 9000}" if i % 10 else None) for h in range(30) for k in "ab" for i in range(600)]
    df = spark.createDataFrame(rows, "timestamp long, k string, v string")
    sketches = metrics.distinct_sketches(df, ["k"], "v")
    assert sketches.count() == 60
    exact = {}
    for t, _, v in rows:
        if v is not None:
            exact.setdefault(t // 86400, set()).add(v)
    found = metrics.roll_up_distinct(sketches, []).orderBy("timestamp").collect()
    assert len(found) == 2
    for day, row in enumerate(found):
        assert row.low <= len(exact[day]) <= row.high and row.high < 1.2 * row.low
    by_key = metrics.roll_up_distinct(sketches, ["k"]).collect()
    assert len(by_key) == 4 and all(r.value == by_key[0].value for r in by_key if r.timestamp == by_key[0].timestamp)
    small = metrics.distinct_sketches(df.where("timestamp = 0").limit(20), ["k"], "v")
    few = df.where("timestamp = 0").limit(20).select("v").distinct().dropna().count()
    assert [r.value for r in metrics.roll_up_distinct(small, []).collect()] == [few]
