"""What the plans of the queries look like."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks.base import QUERIES, dev, dim, lst, pts, table
from tidemark.operators import joins, metrics, moments, profile, reduce, rows, sampling
from tidemark.sources.readers import parse_json


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if not n.startswith(("stream", "speed", "batch", "listing_study", "linkage_in"))]
)
def test_no_cross_join(spark, sf, name):
    text = plan(driver.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_sums_combine_before_the_shuffle(spark, sf):
    text = plan(metrics.metric_by_window(dev(spark, sf), "app"))
    assert "partial_sum" in text and text.count("Exchange") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_all_dimensions_take_one_shuffle_and_one_scan(spark, sf):
    known = joins.enrich(dev(spark, sf), dim(spark, sf))
    text = plan(metrics.metrics_by_dims(known, ["antenna_id", "email", "app"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan") == 2  # messages and users


def test_quota_join_meets_sums_not_messages(spark, sf):
    usage = metrics.metric_by_window(dev(spark, sf), "id")
    text = plan(joins.over_quota(usage, dim(spark, sf)))
    assert text.index("BroadcastHashJoin") < text.index("partial_sum")
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in text


def test_distinct_count_spreads_a_hot_key(spark, sf):
    text = plan(metrics.distinct_by_window(dev(spark, sf), ["app"], "id"))
    assert "partial_count(distinct" in text and text.count("Exchange hashpartitioning(app") == 2


def test_filters_reach_the_scan(spark, sf):
    kept = rows.keep_equal(table(spark, sf, "part"), {"p_brand": "Brand#2", "p_type": "ECONOMY"}).select("p_partkey")
    text = plan(kept)
    assert "EqualTo(p_brand,Brand#2)" in text and "EqualTo(p_type,ECONOMY)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string>" in text


def test_top_rows_are_kept_by_task(spark, sf):
    assert "TakeOrderedAndProject" in plan(rows.head_n(lst(spark, sf), 5, ["key"]))
    assert "TakeOrderedAndProject" in plan(sampling.sample_rows(lst(spark, sf), "key", 5))
    near = reduce.nearest(pts(spark, sf), {"price": 1.0, "tax": 0.1}, ["price", "tax"], "key")
    assert "TakeOrderedAndProject" in plan(near)


@pytest.mark.parametrize("exact", [False, True])
def test_split_does_not_shuffle(spark, sf, exact):
    for part in sampling.split_rows(table(spark, sf, "orders"), "o_orderkey", exact=exact):
        assert "Exchange" not in plan(part)


def test_moments_are_one_aggregate(spark, sf, monkeypatch):
    seen = []
    real = type(spark.range(1)).first
    monkeypatch.setattr(type(spark.range(1)), "first", lambda df: (seen.append(plan(df)), real(df))[1])
    moments.moments(pts(spark, sf), ["price", "tax", "line"])
    assert len(seen) == 1 and seen[0].count("Exchange") == 1 and "partial_sum" in seen[0]


def test_neighbours_of_many_do_not_shuffle_the_rows(spark, sf):
    points = pts(spark, sf)
    asked = spark.createDataFrame([("q", 1.0, 0.1)], "q string, price double, tax double")
    text = plan(reduce.nearest_many(points, asked, ["price", "tax"], "key", "q"))
    assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("MapInPandas")


def test_histogram_counts_combine_before_the_shuffle(spark, sf):
    text = plan(profile.histogram(table(spark, sf, "lineitem"), "l_tax"))
    assert "partial_count" in text and "ReadSchema: struct<l_tax:double>" in text


def test_prediction_stays_in_generated_code(spark, sf):
    z = reduce.standardize(pts(spark, sf), ["price", "tax"]).select("key", "z_price")
    text = plan(z)
    assert "Python" not in text and "Pandas" not in text and "*(1)" in text


def test_null_share_reads_once(spark, sf):
    df = table(spark, sf, "labels").withColumn("quality", F.nullif("quality", F.lit(0)))
    text = plan(profile.null_share(df, ["quality", "toxic"]))
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("bad", ["keep", "drop"])
def test_json_is_parsed_once(spark, bad):
    payloads = spark.range(3).select(F.concat(F.lit('{"timestamp": 1, "id": "'), "id", F.lit('"}')).alias("value"))
    assert plan(parse_json(payloads, bad=bad)).count("from_json") == 1
