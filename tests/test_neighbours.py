"""Nearest rows by blocks and by buckets against a plain comparison of all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import checks.fits  # noqa: F401
from checks.base import QUERIES
from tidemark.operators import neighbours, reduce

SHAPE = "key long, x double, y double, z double"
COLUMNS = ["x", "y", "z"]


def plain(rows, queries, k):
    """Sorted (query, key, place); ties by key."""
    out = []
    for name, *point in queries:
        near = sorted((sum((a - b) ** 2 for a, b in zip(values, point)), key) for key, *values in rows)
        out += [(name, key, i + 1) for i, (_, key) in enumerate(near[:k])]
    return sorted(out)


def got(df):
    return sorted((r["query"], r["key"], r["place"]) for r in df.collect())


@pytest.fixture(scope="module")
def cloud():
    """Clusters of several widths, a crowd on whole numbers, and a third of the rows at one point."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 3)) * 20
    near = centers[rng.integers(0, 12, 900)] + rng.normal(size=(900, 3)) * rng.choice([0.01, 1, 5], 900)[:, None]
    grid = rng.integers(-3, 4, (600, 3)).astype(float)
    same = np.tile([[1.5, -2.0, 0.25]], (750, 1))
    points = np.concatenate([near, grid, same])
    keys = rng.permutation(len(points))
    rows = [(int(i), *map(float, p)) for i, p in zip(keys, points, strict=True)]
    asked = [(int(1000 + i), *map(float, points[j])) for i, j in enumerate(rng.integers(0, len(points), 120))]
    asked += [(5000, 1e3, 1e3, 1e3), (5001, 0.5, 0.5, 0.5)]
    return rows, asked


def frames(spark, cloud):
    rows, asked = cloud
    queries = spark.createDataFrame(asked, SHAPE.replace("key", "query"))
    return spark.createDataFrame(rows, SHAPE).repartition(5), queries.repartition(3)


@pytest.mark.parametrize("options", [{}, {"cells": 1, "row_block": 50, "query_block": 7}, {"cells": 200, "row_block": 3}])
def test_join_equals_comparing_all(spark, cloud, options):
    rows, queries = frames(spark, cloud)
    found = neighbours.nearest_join(rows, queries, COLUMNS, "key", "query", k=7, **options)
    assert got(found) == plain(*cloud, 7)


def test_join_equals_the_way_through_tasks(spark, cloud):
    rows, queries = frames(spark, cloud)
    join = neighbours.nearest_join(rows, queries, COLUMNS, "key", "query")
    many = reduce.nearest_many(rows, queries, COLUMNS, "key", "query")
    assert sorted(map(tuple, join.collect())) == sorted(map(tuple, many.select(join.columns).collect()))


def test_bounds_leave_most_tiles_out(spark):
    """Far clusters are never compared: rows that meet a query are a small share of all."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 3))[rng.integers(0, 40, 8000)] * 100 + rng.normal(size=(8000, 3))
    rows = neighbours.points(
        spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], SHAPE), COLUMNS, "key"
    )
    centers = neighbours.fit_centers(neighbours._sample(rows, 8192), 40)
    rings = neighbours._rings(neighbours.blocks(rows, neighbours._homes(centers), 500), centers)
    need, *_ = rings.needed(points[:500], 0, np.inf, 5)
    assert rings.n.sum() == 8000
    assert (need * rings.n).sum() / (500 * 8000) < 0.15


def test_rows_beyond_all_bounds_are_left_out_where_they_are_read(spark, monkeypatch):
    """Queries near the middle, and two remote ones: the blocks hold the few rows near them."""
    rng = np.random.default_rng(2)
    points = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-1, 1, (6000, 3)))]
    asked = [(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(60, 3)) * 0.05)]
    asked += [(60, 90.0, 0.0, 0.0), (61, 0.0, -70.0, 5.0)]
    dealt = []

    def noted(df, label="cut", write=neighbours.cut_lineage):
        written = write(df, label)
        if label == "row-blocks":
            dealt.append(written.agg(F.sum("n")).first()[0])
        return written

    monkeypatch.setattr(neighbours, "cut_lineage", noted)
    found = neighbours.nearest_join(*frames(spark, (points, asked)), COLUMNS, "key", "query")
    assert got(found) == plain(points, asked, 5)
    assert dealt and sum(dealt) < 1500


@pytest.mark.parametrize("met", [1, 1000])
def test_samples_within_samples_bound_the_distances(spark, cloud, monkeypatch, met):
    monkeypatch.setattr(neighbours, "PART", 4)
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(neighbours, "MOST_MET", met)
    found = neighbours.nearest_join(*frames(spark, cloud), COLUMNS, "key", "query", k=7)
    assert got(found) == plain(*cloud, 7)


def test_a_query_without_a_name_and_rows_that_repeat(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 0.0)] * 2 + [(None, 1.0, 0.0, 0.0), (3, 9.0, 0.0, 0.0)], SHAPE)
    asked = spark.createDataFrame([(None, 0.0, 0.0, 0.0), (7, 8.0, 0.0, 0.0)], SHAPE.replace("key", "query"))
    found = neighbours.nearest_join(rows, asked, COLUMNS, "key", "query", k=3)
    assert [tuple(r) for r in found.orderBy("query", "place").collect()] == [
        (None, 1, 0.0, 1), (None, 1, 0.0, 2), (None, None, 1.0, 3), (7, 3, 1.0, 1), (7, None, 49.0, 2), (7, 1, 64.0, 3),
    ]


def test_rows_are_read_again_only_if_they_come_from_files(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("key"), *[F.col("id").cast("double").alias(c) for c in COLUMNS]).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for rows, same in (
        (table.where("x > 3").withColumn("y", F.col("x") * 2), True),
        (table.withColumn("y", F.rand()), False),
        (table.limit(20), False),
        (table.dropDuplicates(["x"]), False),
        (table.sample(0.5), False),
    ):
        named = neighbours.points(rows, COLUMNS, "key")
        assert (neighbours._kept(named) is named) == same


def test_the_best_of_many_equal_values(monkeypatch):
    monkeypatch.setattr(neighbours, "PAIR_CELLS", 100)
    values = np.concatenate([np.ones((300, 2)), np.zeros((3, 2)), np.full((300, 2), 2.0)])
    asked = np.array([[1.0, 1.0], [0.0, 0.0], [2.0, 2.0]])
    who, which, gap = neighbours.best_of(asked, values, 4)
    assert who.tolist() == [0] * 4 + [1] * 4 + [2] * 4
    assert which.tolist() == [0, 1, 2, 3, 300, 301, 302, 0, 303, 304, 305, 306]
    assert gap.tolist() == [0.0] * 7 + [2.0] + [0.0] * 4
    order = neighbours.in_leaves(values, neighbours.LEAF)
    found = list(neighbours.best_within(asked, np.full(3, 1.5), values, order, 4))
    assert [x.tolist() for x in found[0]] == [who.tolist(), which.tolist(), gap.tolist()]


def test_blocks_and_samples_do_not_pass_through_the_driver(spark, cloud):
    """Repeated queries compress so well that Spark took their blocks for a small table."""
    rows, queries = frames(spark, cloud)
    index = neighbours.build_index(rows, COLUMNS, "key", bucket=60)
    for found in (
        neighbours.nearest_join(rows, queries, COLUMNS, "key", "query", cells=40),
        neighbours.nearest_index(index, queries, COLUMNS, "key", "query"),
    ):
        found.collect()
        assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("copies", [1, 400])
def test_a_sample_is_the_rows_of_the_smallest_hashes(spark, copies):
    some = spark.range(4000).select(F.col("id").alias("name"), F.array(F.col("id").cast("double")).alias("vec"))
    some = some.where(f"name < {4000 // copies}").crossJoin(spark.range(copies)).drop("id")
    wanted = some.orderBy(F.xxhash64("name", "vec")).limit(50).collect()
    assert sorted(neighbours._sample(some, 50, 4000)[:, 0]) == sorted(r["vec"][0] for r in wanted)


def test_an_empty_index_has_no_answers(spark):
    empty = neighbours.build_index(spark.createDataFrame([], "key long, vec array<double>"), "vec", "key")
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "query long, vec array<double>")
    for exact in (False, True):
        found = neighbours.nearest_index(empty, asked, "vec", "key", "query", exact=exact)
        assert found.columns == ["query", "key", "distance", "place"] and found.isEmpty()


def test_equal_rows_travel_k_times_at_most(spark):
    rows = neighbours.points(spark.createDataFrame([(i, 1.0, 2.0, 3.0) for i in range(500)], SHAPE), COLUMNS, "key")
    assert sorted(r["name"] for r in neighbours._least_keys(rows, 4).collect()) == [0, 1, 2, 3]


def test_equal_points_are_told_by_their_hash_first_and_by_their_values(spark):
    """Zeros of either sign are equal; the sort begins with a hash, as arrays have no prefix to sort by."""
    shape = "key long, x double, y double, z double"
    rows = spark.createDataFrame([(i, 0.0 if i % 2 else -0.0, 2.0, 3.0) for i in range(40)], shape)
    least = neighbours._least_keys(neighbours.points(rows, COLUMNS, "key"), 3)
    assert sorted(r["name"] for r in least.collect()) == [0, 1, 2]
    assert "xxhash64" in least._jdf.queryExecution().executedPlan().toString()


def test_names_of_any_kind_missing_values_and_few_rows(spark):
    rows = spark.createDataFrame(
        [("b", 0.0, 0.0, 0.0), ("a", 0.0, 0.0, 0.0), ("c", None, 0.0, 0.0), ("d", float("nan"), 0.0, 0.0)],
        "key string, x double, y double, z double",
    )
    asked = spark.createDataFrame([("q", 1.0, 0.0, -0.0)], "query string, x double, y double, z double")
    found = neighbours.nearest_join(rows, asked, COLUMNS, "key", "query")
    assert [tuple(r) for r in found.orderBy("place").collect()] == [("q", "a", 1.0, 1), ("q", "b", 1.0, 2)]
    assert neighbours.nearest_join(rows.limit(0), asked, COLUMNS, "key", "query").count() == 0
    assert neighbours.nearest_join(rows, asked.limit(0), COLUMNS, "key", "query").count() == 0
    twice = neighbours.nearest_join(rows, asked.union(asked), COLUMNS, "key", "query")
    assert twice.count() == 2
    with pytest.raises(ValueError):
        neighbours.nearest_join(rows, rows.withColumnRenamed("key", "query"), COLUMNS, "key", "query")
    empty = neighbours.build_index(rows.limit(0), COLUMNS, "key")
    assert neighbours.nearest_index(empty, asked, COLUMNS, "key", "query").count() == 0
    assert neighbours.nearest_index(empty, asked, COLUMNS, "key", "query", exact=True).count() == 0


def test_index_recall_and_the_exact_answer(spark, cloud):
    rows, queries = frames(spark, cloud)
    index = neighbours.build_index(rows, COLUMNS, "key", bucket=60)
    truth = neighbours.nearest_join(rows, queries, COLUMNS, "key", "query")
    found = neighbours.nearest_index(index, queries, COLUMNS, "key", "query")
    assert neighbours.recall(found, truth, "key", "query") >= 0.9, neighbours.recall(found, truth, "key", "query")
    exact = neighbours.nearest_index(index, queries, COLUMNS, "key", "query", probes=1, exact=True)
    assert got(exact) == plain(*cloud, 5)


def test_a_lookup_deals_only_the_rows_of_buckets_it_opens(spark, monkeypatch):
    """Neither the index nor a lookup writes all rows once for each table."""
    rng = np.random.default_rng(4)
    points = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-1, 1, (6000, 3)))]
    asked = [(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(20, 3)) * 0.02)]
    written = []

    def noted(df, label="cut", write=neighbours.cut_lineage):
        table = write(df, label)
        written.append((label, table.agg(F.sum("n")).first()[0] if "n" in table.columns else table.count()))
        return table

    monkeypatch.setattr(neighbours, "cut_lineage", noted)
    rows, queries = frames(spark, (points, asked))
    index = neighbours.build_index(rows, COLUMNS, "key", bucket=30)
    exact = neighbours.nearest_index(index, queries, COLUMNS, "key", "query", probes=2, exact=True)
    assert got(exact) == plain(points, asked, 5)
    # The rows don't come from a file, so they are written, once.
    assert [n for label, n in written if n >= 3000 and label != "sample"] == [6000]


def test_marked_buckets_lose_no_row(spark, cloud, monkeypatch):
    """Few marks open almost all buckets; the answers are the same."""
    rows, queries = frames(spark, cloud)
    rows = rows.union(rows.where("key % 10 = 0"))
    index = neighbours.build_index(rows, COLUMNS, "key", bucket=60)
    answers = []
    for slots in (2**20, 8):
        monkeypatch.setattr(neighbours, "SLOTS", slots)
        answers.append(sorted(map(tuple, neighbours.nearest_index(index, queries, COLUMNS, "key", "query", k=7, probes=2).collect())))
    assert answers[0] == answers[1] and len(answers[0]) > 800
    assert len({r[:2] for r in answers[0]}) == len(answers[0])


def test_every_row_is_in_one_bucket_of_each_table(spark, cloud):
    rows, _ = frames(spark, cloud)
    index = neighbours.build_index(rows, COLUMNS, "key", tables=3, bucket=40, row_block=16)
    names = index.blocks.select(F.explode("names").alias("name")).groupBy("name").count()
    assert names.count() == rows.count() and names.where("count <> 3").isEmpty()
    assert index.blocks.where("n > 16").isEmpty()
    assert index.blocks.select("cell").distinct().count() > 100


def test_recall_on_the_vectors(spark, sf):
    found = QUERIES["nearest_index"](spark, sf)
    truth = QUERIES["nearest_vectors"](spark, sf)
    assert found.count() == truth.count()
    assert neighbours.recall(found, truth, "vec_id", "query_id") >= 0.9
