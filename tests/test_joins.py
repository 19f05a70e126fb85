from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def fact(spark):
    # One key holds a third of the rows, another is unknown, some are null.
    hot = spark.range(3000).select(F.lit("hot").alias("id"), F.col("id").alias("n"))
    cold = spark.range(5000).select((F.col("id") % 700).cast("string").alias("id"), F.col("id").alias("n"))
    none = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, "nobody").alias("id"), F.col("id").alias("n")
    )
    return hot.unionByName(cold).unionByName(none)


@pytest.fixture(scope="module")
def dim(spark):
    known = spark.range(600).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("quota"))
    return known.unionByName(spark.createDataFrame([("hot", -1), ("7", 99)], "id string, quota long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [10_000, 100, 1])
def test_join_dimension_equals_plain_join(fact, dim, how, max_rows):
    assert rows(joins.join_dimension(fact, dim, "id", how, max_rows)) == rows(fact.join(dim, "id", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_on_both_sides_is_salted(spark, fact, dim, how):
    more = dim.unionByName(spark.range(50).select(F.lit("hot").alias("id"), F.col("id").alias("quota")))
    joined = joins.join_dimension(fact, more, "id", how, max_rows=10)
    assert rows(joined) == rows(fact.join(more, "id", how))
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_found_and_bounded(fact):
    hashes = joins.hot_key_hashes(fact, ["id"], 0.05)
    named = fact.select("id", F.xxhash64("id").alias("h")).where(F.col("h").isin(hashes)).distinct()
    assert {row.id for row in named.collect()} == {"hot", "nobody"}


def test_hot_keys_take_one_pass_over_the_fact(fact, dim, tmp_path):
    fact.write.parquet(f"{tmp_path}/fact")
    stored = fact.sparkSession.read.parquet(f"{tmp_path}/fact")
    joined = joins.join_dimension(stored, dim, "id", "inner", max_rows=100)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "_salt" in plan
    assert rows(joined) == rows(fact.join(dim, "id"))


def test_small_dimension_is_broadcast(fact, dim):
    plan = joins.enrich(fact, dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_size_check(spark):
    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text"))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=99)
    assert not joins.fits_broadcast(df, max_bytes=50_000)


def test_different_key_types_are_refused(spark, fact):
    numbers = spark.range(600).select("id", F.lit(1).alias("quota"))
    with pytest.raises(ValueError, match="id is string"):
        joins.join_dimension(fact, numbers, "id", max_rows=10)


def test_enrich_can_require_unique_keys(fact, dim):
    with pytest.raises(ValueError, match="occurs 2 times"):
        joins.enrich(fact, dim, require_unique=True)


def test_over_quota_compares_inside_the_join(spark):
    usage = spark.createDataFrame([("a", 10, 1), ("a", 5, 2), ("b", 9, 1)], "id string, value long, timestamp long")
    dim = spark.createDataFrame([("a", "a@x", 5), ("b", "b@x", 9)], "id string, email string, quota long")
    found = joins.over_quota(usage, dim)
    assert found.collect() == [("a@x", 10, 5, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "(usage#" in plan


def test_drop_groups_without_keeps_partly_known_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", None), (None, 2.0)], "g string, x double"
    )
    assert rows(joins.drop_groups_without(df, "g", "x")) == Counter([("a", 1.0), ("a", None), (None, 2.0)])
