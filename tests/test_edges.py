"""Rows at the edge of what the operators are made for."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import groups, order, reduce, regress
from tidemark.plans.batch import BatchConfig, run_batch_layer
from tidemark.schemas import METRIC, USER_METADATA
from tidemark.sources import readers, sinks
from tidemark.functions.scalar import with_date_parts


def test_groups_of_one_row_have_no_error(spark):
    lone = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 2.0), ("t", "a", 1.0), ("t", "a", 2.0), ("t", "b", 5.0)], "seg string, g string, v double")
    found = {r.seg: r for r in groups.tukey_pairs(lone, "v", "g", by=["seg"]).collect()}
    assert found["s"]["diff"] == 1.0 and found["s"].se is None and found["s"].q is None
    assert found["t"].se > 0 and 0 <= found["t"].p <= 1


def test_a_null_segment_is_a_segment(spark):
    rows = [(s, g, float(v)) for s in ("x", None) for g in ("a", "b", "c") for v in range(ord(g) - 90, ord(g) - 85)]
    df = spark.createDataFrame(rows, "seg string, g string, v double")
    assert {r.seg for r in groups.anova_oneway(df, "v", "g", by=["seg"]).collect()} == {"x", None}
    pairs = groups.tukey_pairs(df, "v", "g", by=["seg"])
    assert pairs.groupBy("seg").count().collect().__len__() == 2 and pairs.count() == 6


def test_pairs_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK_ROWS", 3)
    df = spark.createDataFrame([(f"g{i:02d}", float(i + j)) for i in range(11) for j in (0, 1)], "g string, v double")
    found = groups.tukey_pairs(df, "v", "g").collect()
    assert len({(r.a, r.b) for r in found}) == len(found) == 55
    assert all(r.a < r.b and math.isclose(r["diff"], int(r.b[1:]) - int(r.a[1:])) for r in found)
    plan = groups.tukey_pairs(df, "v", "g")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_distances_go_by_column(spark):
    cells = [("r1", "x", 1.0), ("r1", "y", 2.0), ("r2", "y", 4.0), ("r2", "z", 3.0), ("r3", "w", 1.0), ("r3", "z", None)]
    found = groups.row_distances(spark.createDataFrame(cells, "a string, b string, value double"))
    got = {(r.a, r.b): r.distance for r in found.collect()}
    assert math.isclose(got[("r1", "r2")], math.sqrt(4 * 4 / 1))
    assert got[("r1", "r3")] is None and got[("r2", "r3")] is None


def test_linkage_of_a_long_chain(spark):
    k = 300
    gaps = spark.createDataFrame(
        [(f"{i:04d}", f"{j:04d}", float(abs(i * i - j * j))) for i in range(k) for j in range(i + 1, k)],
        "a string, b string, distance double",
    )
    merges = groups.complete_linkage(gaps).orderBy("step").collect()
    assert len(merges) == k - 1 and [m.height for m in merges] == sorted(m.height for m in merges)
    small = gaps.where("a < '0012' and b < '0012'")
    one, two = (groups.complete_linkage(small, local_members=n).orderBy("step").collect() for n in (100, 2))
    assert one == two
    tops, ranked = (groups.cut_clusters(groups.complete_linkage(small), 40.0, local_members=n).collect() for n in (100, 2))
    assert sorted(tops) == sorted(ranked)


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("s"), F.hash("id").alias("v"), "id")
    found = groups.numbered(df, ["v", "id"], "n", ["s"]).collect()
    for s in range(7):
        part = sorted((r.v, r.id, r.n) for r in found if r.s == s)
        assert [n for _, _, n in part] == list(range(1, len(part) + 1))


def test_not_a_number_is_an_unknown_value(spark):
    rows = [(float(i), 3.0 * i + (i % 3)) for i in range(20)] + [(float("nan"), 1.0), (2.0, float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    fit = regress.fit_ols(df, "y", ["x"])
    assert fit.n == 20 and fit.sigma > 0
    assert regress.predict_ols(df, fit).where("predicted is null").count() == 2
    assert regress.rmse(regress.predict_ols(df, fit), "y", "predicted").first()["n"] == 20
    assert regress.impute_ols(df, fit).where(F.isnan("y")).count() == 0
    with pytest.raises(ValueError, match="missing"):
        reduce.nearest_many(df.withColumn("k", F.lit(1)), df.withColumn("q", F.lit(1)), ["x", "y"], "k", "q")


def test_categories_enter_as_indicators(spark):
    rows = [(c, float(i), {"a": 1.0, "b": 5.0, "c": -2.0}[c] + 2.0 * i) for i in range(8) for c in "abc"]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0)], "c string, x double, y double")
    fit = regress.fit_ols(df, "y", ["x"], categorical=["c"])
    assert fit.n == 24 and fit.xs == ("x", "c=b", "c=c")
    assert [round(v, 9) for v in (fit.intercept, *fit.slopes)] == [1.0, 2.0, 4.0, -3.0]
    asked = spark.createDataFrame([("a", 1.0), ("c", 0.0), ("new", 0.0), (None, 0.0)], "c string, x double")
    assert [r.predicted and round(r.predicted, 9) for r in regress.predict_ols(asked, fit).collect()] == [3.0, -2.0, None, None]
    assert regress.ols_diagnostics(df, fit).count() == 24


def test_leverage_of_one_has_no_residual(spark):
    rows = [(1.0 if i == 0 else 0.0, float(i % 5), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "lone double, x double, y double").withColumn("k", F.monotonically_increasing_id())
    found = regress.ols_diagnostics(df, regress.fit_ols(df, "y", ["lone", "x"]), "k").collect()
    alone = next(r for r in found if r.lone == 1.0)
    assert alone.std_residual is None and alone.cooks is None and alone.normal_quantile is None
    assert sum(r.std_residual is not None for r in found) == 11


def test_ranks_leave_out_what_is_no_number(spark):
    values = [3.0, float("nan"), float("inf"), float("-inf"), None, 1.0, 2.0]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v double")
    got = {r.k: r["rank"] for r in order.global_rank(df, "v", "k").collect()}
    assert got == {3: 1, 5: 2, 6: 3, 0: 4, 2: 5, 1: None, 4: None}


def test_an_empty_dimension_can_be_loaded_and_grow(spark, tmp_path):
    path = f"{tmp_path}/users"
    assert sinks.load_dimension(spark, spark.createDataFrame([], USER_METADATA), path).count() == 0
    more = spark.createDataFrame([("1", "a", "a@x", 5)], USER_METADATA)
    sinks.load_dimension(spark, more, path)
    assert sinks.load_dimension(spark, more.withColumn("quota", F.lit(7).cast("long")), path).first().quota == 7


def test_columns_of_separated_text_go_by_name(spark, tmp_path):
    (tmp_path / "users.csv").write_text("name;Id;e mail;quota;extra\nUna;u;una@x;10;z\n")
    users = readers.read_delimited(spark, str(tmp_path), "id STRING, name STRING, quota BIGINT")
    assert [tuple(r) for r in users.collect()] == [("u", "Una", 10)]
    with pytest.raises(ValueError, match="missing"):
        readers.read_delimited(spark, str(tmp_path), "id STRING, missing STRING")


def test_parts_of_a_date_are_utc_in_any_zone(spark):
    df = spark.createDataFrame([(1704126245,), (-1,)], "timestamp long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [tuple(r)[1:] for r in with_date_parts(df).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(2024, 1, 1, 16), (1969, 12, 31, 23)]


def test_an_hour_without_rows_is_emptied(spark, tmp_path):
    table = sinks.FileTable(f"{tmp_path}/metrics")
    hour = datetime(2024, 1, 1, 16, tzinfo=timezone.utc)
    rows = [(hour + timedelta(hours=i), "a", i, "t") for i in range(3)]
    labels = ["20240101T16", "20240101T17", "20240101T18"]
    table.write_hours(spark.createDataFrame(rows, METRIC), "job", labels)
    table.write_hours(spark.createDataFrame([], METRIC), "job", labels[:1])
    assert sorted(r.value for r in table.read(spark, METRIC).collect()) == [1, 2]


@pytest.mark.parametrize("window", ["7 minutes", "2 hours", "1 day"])
def test_windows_across_hours_are_refused(spark, window):
    config = BatchConfig("", "", sinks.FileTable(""), sinks.FileTable(""), window=window)
    with pytest.raises(ValueError, match="divide"):
        run_batch_layer(spark, None, config, datetime(2024, 1, 1, 16))


def test_a_start_inside_an_hour_is_refused(spark):
    config = BatchConfig("", "", sinks.FileTable(""), sinks.FileTable(""))
    with pytest.raises(ValueError, match="hour"):
        run_batch_layer(spark, None, config, datetime(2024, 1, 1, 16, 30))
