from __future__ import annotations

import itertools
import math
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.distributions import StudentizedRange, beta_tail, f_upper, t_two_sided
from tidemark.operators import groups

# Published upper 5 % points of the studentized range: (q, groups, degrees of freedom).
TABLE = [(3.578, 3, 20), (3.977, 5, 60), (5.008, 10, 20), (3.314, 3, 10**9), (4.474, 10, 10**9), (8.331, 3, 2)]


@pytest.mark.parametrize("q,k,freedom", TABLE)
def test_studentized_range_points(q, k, freedom):
    table = StudentizedRange(k, freedom)
    assert table.upper_tail(np.array([q]))[0] == pytest.approx(0.05, abs=2e-4)
    assert table.critical(0.05) == pytest.approx(q, abs=2e-3)


def test_studentized_range_of_two_groups_is_student():
    # With two groups q = sqrt(2) * |t|.
    table = StudentizedRange(2, 15)
    for t in (0.1, 0.7, 2.131, 4.0):
        assert table.upper_tail(np.array([math.sqrt(2) * t]))[0] == pytest.approx(t_two_sided(t, 15), abs=1e-7)


def test_tails():
    assert t_two_sided(2.131449546, 15) == pytest.approx(0.05, abs=1e-8)
    assert t_two_sided(0.0, 5) == 1.0
    assert f_upper(4.0, 1, 10) == pytest.approx(t_two_sided(2.0, 10), abs=1e-12)
    assert f_upper(3.325835, 4, 11) == pytest.approx(0.0513, abs=1e-3)
    assert beta_tail(0.3, 2, 3) == pytest.approx(0.3483, abs=1e-12)  # polynomial case


@pytest.fixture(scope="module")
def measured(spark):
    draw = random.Random(5)
    rows = [
        (g, draw.gauss(mean, 2.0)) for g, mean, n in [("a", 1, 30), ("b", 2, 7), ("c", 6, 50)] for _ in range(n)
    ]
    return spark.createDataFrame([*rows, ("a", None), (None, 3.0)], "g string, y double"), pd.DataFrame(
        rows, columns=["g", "y"]
    )


def test_anova_against_definition(measured):
    df, pdf = measured
    found = groups.anova_oneway(df, "y", "g").first()
    grand = pdf.y.mean()
    by = pdf.groupby("g").y
    between = (by.count() * (by.mean() - grand) ** 2).sum()
    within = ((pdf.y - by.transform("mean")) ** 2).sum()
    assert (found.k, found.df_between, found.df_within) == (3, 2, 84)
    assert found.ss_between == pytest.approx(between) and found.ss_within == pytest.approx(within)
    assert found.f == pytest.approx(between / 2 / (within / 84))


def test_anova_survives_large_means(measured):
    df, _ = measured
    plain = groups.anova_oneway(df, "y", "g").first()
    moved = groups.anova_oneway(df.withColumn("y", F.col("y") + 1e8), "y", "g").first()
    assert moved.f == pytest.approx(plain.f, rel=1e-5)


def test_tukey_bounds_and_direction(measured):
    df, pdf = measured
    found = {(r.a, r.b): r for r in groups.tukey_pairs(df, "y", "g").collect()}
    assert set(found) == {("a", "b"), ("a", "c"), ("b", "c")}
    means = pdf.groupby("g").y.mean()
    critical = StudentizedRange(3, 84).critical(0.05)
    for (a, b), row in found.items():
        assert row["diff"] == pytest.approx(means[b] - means[a])
        assert row.upper - row.lower == pytest.approx(2 * critical * row.se)
        assert (row.p < 0.05) == (row.lower > 0 or row.upper < 0)


def test_tukey_without_variance(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("c", 2.0), ("c", 2.0)], "g string, y double")
    found = {(r.a, r.b): r.p for r in groups.tukey_pairs(df, "y", "g").collect()}
    assert found == pytest.approx({("a", "b"): 1.0, ("a", "c"): 0.0, ("b", "c"): 0.0}, abs=1e-12)


def test_tukey_by_segment(measured):
    df, _ = measured
    both = df.withColumn("city", F.lit("x")).unionByName(df.withColumns({"city": F.lit("y"), "y": F.col("y") * 3}))
    found = groups.tukey_pairs(both, "y", "g", by=["city"]).collect()
    alone = {(r.a, r.b): r.q for r in groups.tukey_pairs(df, "y", "g").collect()}
    assert len(found) == 6
    for row in found:
        assert row.q == pytest.approx(alone[(row.a, row.b)])


def test_symmetric_pairs(spark):
    pairs = spark.createDataFrame([("a", "b", 0.123456), ("a", "c", 0.5), ("b", "c", 1.0)], "a string, b string, p double")
    found = {(r.a, r.b): r.value for r in groups.symmetric_pairs(pairs, "p").collect()}
    assert len(found) == 9
    assert found[("a", "b")] == found[("b", "a")] == 0.1235 and found[("c", "c")] == 1.0


@pytest.mark.parametrize("block_rows", [3, 256])
def test_row_distances(spark, monkeypatch, block_rows):
    monkeypatch.setattr(groups, "BLOCK_ROWS", block_rows)
    values = np.random.default_rng(3).random((11, 6))
    cells = [(f"r{i:02d}", f"c{j}", float(values[i, j])) for i in range(11) for j in range(6)]
    found = groups.row_distances(spark.createDataFrame(cells, "a string, b string, value double")).collect()
    assert len(found) == 55 and all(r.a < r.b for r in found)
    for r in found:
        gap = np.linalg.norm(values[int(r.a[1:])] - values[int(r.b[1:])])
        assert r.distance == pytest.approx(gap)


def test_linkage_worked_by_hand(spark):
    # Points 0, 1, 5, 7 on a line: {0,1} at 1, {5,7} at 2, all at 7.
    points = {"a": 0.0, "b": 1.0, "c": 5.0, "d": 7.0}
    rows = [(x, y, abs(points[x] - points[y])) for x, y in itertools.combinations(points, 2)]
    merges = groups.complete_linkage(spark.createDataFrame(rows, "a string, b string, distance double"))
    assert [tuple(r) for r in merges.orderBy("step").collect()] == [
        (1, "a", "b", 1.0, 2),
        (2, "c", "d", 2.0, 2),
        (3, "a", "c", 7.0, 4),
    ]
    cut = {h: {r.member: r.cluster for r in groups.cut_clusters(merges, h).collect()} for h in (0.5, 1, 2, 7)}
    assert cut[0.5] == {"a": 1, "b": 2, "c": 3, "d": 4}
    assert cut[1] == {"a": 1, "b": 1, "c": 2, "d": 3}
    assert cut[2] == {"a": 1, "b": 1, "c": 2, "d": 2}
    assert set(cut[7].values()) == {1}
    assert [r.step for r in groups.upper_merges(merges, 1.0).collect()] == [2, 3]


@pytest.fixture(scope="module")
def segmented(spark):
    # Whole distances, so that many are equal; segments of different sizes.
    draw = random.Random(8)
    rows = [
        (city, f"n{i:02d}", f"n{j:02d}", float(draw.randint(1, 6)))
        for city, k in (("x", 12), ("y", 2), ("z", 7))
        for i, j in itertools.combinations(range(k), 2)
    ]
    return spark.createDataFrame(rows, "city string, a string, b string, distance double"), rows


def linked(rows):
    """Complete linkage straight from its definition."""
    found = []
    for city in sorted({r[0] for r in rows}):
        gap = {frozenset(r[1:3]): r[3] for r in rows if r[0] == city}
        clusters = [[name] for name in sorted({n for r in rows if r[0] == city for n in r[1:3]})]
        step = 0
        while len(clusters) > 1:
            step += 1
            height, left, right = min(
                (max(gap[frozenset((p, q))] for p in x for q in y), min(x), min(y))
                for x, y in itertools.combinations(sorted(clusters), 2)
            )
            one, two = (next(c for c in clusters if min(c) == n) for n in (left, right))
            clusters = [c for c in clusters if c not in (one, two)] + [sorted(one + two)]
            found.append((city, step, left, right, height, len(one) + len(two)))
    return sorted(found)


@pytest.mark.parametrize("local_members", [1, 7, 100])
def test_linkage_with_ties_and_segments(segmented, local_members):
    df, rows = segmented
    merges = groups.complete_linkage(df, ["city"], local_members)
    found = sorted(tuple(r) for r in merges.select("city", "step", "left", "right", "height", "size").collect())
    assert found == linked(rows)


@pytest.mark.parametrize("chain_members", [1, 2, 4, 100])
def test_linkage_along_chains_of_any_part(segmented, chain_members):
    df, rows = segmented
    merges = groups.complete_linkage(df, ["city"], 1, chain_members)
    found = sorted(tuple(r) for r in merges.select("city", "step", "left", "right", "height", "size").collect())
    assert found == linked(rows)


@pytest.mark.parametrize("seed", range(3))
def test_linkage_along_chains_equals_one_task(spark, seed):
    """Points on a line, in the plane and with equal gaps; parts much smaller than the chains."""
    draw = random.Random(seed)
    places = {f"p{i:02d}": (draw.choice([0, 0, draw.random()]), draw.randint(0, 12) if seed else draw.random()) for i in range(45)}
    rows = [(p, q, math.dist(places[p], places[q])) for p, q in itertools.combinations(sorted(places), 2)]
    df = spark.createDataFrame(rows, "a string, b string, distance double")
    want = [tuple(r) for r in groups.complete_linkage(df).orderBy("step").collect()]
    for most in (5, 1000):
        assert [tuple(r) for r in groups.complete_linkage(df, (), 1, most).orderBy("step").collect()] == want


def test_a_chain_is_merged_in_one_round(spark, monkeypatch):
    """Every merge waits for the one before: gaps that grow along a line of 300 groups."""
    counted = []
    final = groups._final_names
    monkeypatch.setattr(groups, "_final_names", lambda merges, keys: counted.append(1) or final(merges, keys))
    at = np.cumsum(1 + np.arange(300) * 0.01)
    i, j = np.triu_indices(300, 1)
    pairs = pd.DataFrame({"a": i, "b": j, "distance": at[j] - at[i]})
    df = spark.createDataFrame(pairs, "a long, b long, distance double")
    want = [tuple(r) for r in groups.complete_linkage(df).orderBy("step").collect()]
    assert [tuple(r) for r in groups.complete_linkage(df, local_members=1).orderBy("step").collect()] == want
    assert len(counted) == 1 and len(want) == 299


@pytest.mark.parametrize("height", [0.0, 3.0, 4.0, 6.0])
def test_cut_in_tasks_equals_cut_in_rounds(segmented, height):
    merges = groups.complete_linkage(segmented[0], ["city"])
    tasks, rounds = (
        {tuple(r) for r in groups.cut_clusters(merges, height, ["city"], local_members=m).collect()} for m in (100, 1)
    )
    assert tasks == rounds and len(tasks) == 21


def test_cut_covers_a_segment_of_one(spark):
    members = spark.createDataFrame([("only",)], "member string")
    merges = groups.complete_linkage(spark.createDataFrame([], "a string, b string, distance double"))
    assert groups.cut_clusters(merges, 1.0, members=members).collect() == [("only", 1)]


def test_rank_components(spark):
    draw = random.Random(4)
    rows = [(f"g{i % 3}", draw.gauss(0, 1), (i % 3) * 5 + draw.gauss(0, 1)) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, pc1 double, pc2 double")
    found = groups.rank_components(df, ["pc1", "pc2"], "g").collect()
    assert [r.component for r in found] == ["pc2", "pc1"]
    assert found[0].f == pytest.approx(groups.anova_oneway(df, "pc2", "g").first().f)


def test_unpivot(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "k int, x double, y double")
    assert {tuple(r) for r in groups.unpivot(df, ["k"], ["x", "y"]).collect()} == {(1, "x", 2.0), (1, "y", None)}
