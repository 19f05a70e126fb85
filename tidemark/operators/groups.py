"""Comparison of groups: analysis of variance, pairwise tests, clustering of groups.

The rows are reduced to one line of statistics for each group before anything is
paired, so the work after the first shuffle depends on the number of groups, not
on their sizes. ``by`` names optional segment columns; all segments are handled
side by side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.functions.distributions import studentized_range
from tidemark.operators.joins import fits_broadcast, join_dimension
from tidemark.session import cut_lineage, scratch_path

BLOCK_ROWS = 256
BLOCK_CELLS = 4_000_000
# Members up to which one task merges a segment: its matrix has 72 MB.
LOCAL_MEMBERS = 3000


def group_stats(df: DataFrame, value: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and variance of the known values by group."""
    return (
        df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
        .groupBy(*by, group)
        .agg(
            F.count("*").alias("n"),
            F.avg(value).alias("mean"),
            F.coalesce(F.var_samp(value), F.lit(0.0)).alias("variance"),
        )
    )


def _join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key is a key like any other; the keys appear once."""
    named = right.withColumnsRenamed({name: f"_right_{name}" for name in keys})
    alike = [left[name].eqNullSafe(named[f"_right_{name}"]) for name in keys]
    return left.join(named, reduce(lambda a, b: a & b, alike), how).drop(*[f"_right_{name}" for name in keys])


def _with_segment(df: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the columns of each row's segment, also of the null one; without segments the only row becomes constants."""
    if by:
        return _join_same(df, facts, by)
    row = facts.first()
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in facts.schema.fields})


def anova_from_stats(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance, one row by segment, from :func:`group_stats`.

    Deviations are taken from the grand mean, so large means do not cancel.
    """
    grand = stats.groupBy(*by).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    sums = (
        _with_segment(stats, grand, by)
        .groupBy(*by)
        .agg(
            F.count("*").alias("k"),
            (F.count("*") - 1).alias("df_between"),
            (F.sum("n") - F.count("*")).alias("df_within"),
            F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("ss_between"),
            F.sum((F.col("n") - 1) * F.col("variance")).alias("ss_within"),
        )
    )
    ms_within = F.try_divide("ss_within", "df_within")
    f = F.try_divide(F.try_divide("ss_between", "df_between"), ms_within)
    return sums.withColumns({"ms_within": ms_within, "f": f})


def anova_oneway(df: DataFrame, value: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance of ``value`` by ``group``; unknown values are left out."""
    return anova_from_stats(cut_lineage(group_stats(df, value, group, by)), by)


def tukey_pairs(
    df: DataFrame, value: str, group: str, confidence: float = 0.95, by: Sequence[str] = ()
) -> DataFrame:
    """Tukey-Kramer comparison of every pair of groups ``a < b``.

    ``diff`` is mean of b minus mean of a, with simultaneous bounds and the
    adjusted p-value; k groups give k(k-1)/2 rows. Where no group has two rows, nothing is known about the
    error: se, q, p and bounds are null. Groups are dealt into blocks and every two blocks meet in an
    equi-join, so no task ranks all groups. The p-values are computed where the pairs are.
    """
    stats = cut_lineage(group_stats(df, value, group, by))
    error = anova_from_stats(stats, by).select(*by, "k", "df_within", "ms_within")
    blocks = max(1, math.ceil(stats.count() / BLOCK_ROWS))
    own = F.pmod(F.xxhash64(group), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = stats.withColumn("_own", own).withColumn("_other", every)
    dealt = dealt.withColumns({"_low": F.least("_own", "_other"), "_high": F.greatest("_own", "_other")})
    facts = F.struct(F.col(group).alias("name"), "n", "mean")
    left = dealt.where("_own = _low").select(*by, "_low", "_high", facts.alias("x"))
    right = dealt.where("_own = _high").select(*by, "_low", "_high", facts.alias("y"))
    met = _join_same(left, right, [*by, "_low", "_high"])
    met = met.where(
        F.when(F.col("_low") == F.col("_high"), F.col("x.name") < F.col("y.name")).otherwise(F.lit(True))
    )
    turned = F.col("x.name") > F.col("y.name")
    first, second = F.when(turned, F.col("y")).otherwise(F.col("x")), F.when(turned, F.col("x")).otherwise(F.col("y"))
    met = met.select(*by, first.alias("x"), second.alias("y"))
    pairs = _with_segment(met, error, by).select(
        *by,
        F.col("x.name").alias("a"),
        F.col("x.n").alias("n_a"),
        F.col("x.mean").alias("mean_a"),
        F.col("y.name").alias("b"),
        F.col("y.n").alias("n_b"),
        F.col("y.mean").alias("mean_b"),
        "k",
        "df_within",
        "ms_within",
    )
    se = F.sqrt(F.col("ms_within") / 2 * (1 / F.col("n_a") + 1 / F.col("n_b")))
    apart = F.abs("diff")
    pairs = (
        pairs.withColumn("diff", F.col("mean_b") - F.col("mean_a"))
        .withColumn("se", se)
        .withColumn(
            "q",
            F.when(F.col("se").isNull(), F.lit(None))
            .when(F.col("se") > 0, apart / F.col("se"))
            .when(apart == 0, F.lit(0.0))
            .otherwise(F.lit(float("inf"))),
        )
    )
    tail = studentized_range("q", F.col("k"), F.col("df_within"), F.lit(1.0 - confidence))
    return pairs.withColumn("tail", tail).select(
        *by,
        "a",
        "b",
        "diff",
        "se",
        "q",
        (F.col("diff") - F.col("tail.critical") * F.col("se")).alias("lower"),
        (F.col("diff") + F.col("tail.critical") * F.col("se")).alias("upper"),
        F.col("tail.p").alias("p"),
    )


def symmetric_pairs(
    pairs: DataFrame,
    value: str,
    a: str = "a",
    b: str = "b",
    diagonal: float = 1.0,
    digits: int | None = 4,
    by: Sequence[str] = (),
) -> DataFrame:
    """Long symmetric matrix ``(a, b, value)`` from the pairs ``a < b``, with its diagonal."""
    cell = F.round(value, digits) if digits is not None else F.col(value)
    both = F.array(
        F.struct(F.col(a).alias("a"), F.col(b).alias("b")),
        F.struct(F.col(b).alias("a"), F.col(a).alias("b")),
    )
    mirrored = pairs.select(*by, cell.alias("value"), F.explode(both).alias("at"))
    members = pairs.select(*by, F.explode(F.array(a, b)).alias("a")).distinct()
    return mirrored.select(*by, "at.a", "at.b", "value").unionByName(
        members.select(*by, "a", F.col("a").alias("b"), F.lit(diagonal).alias("value"))
    )


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Wide to long: one row for each id and column."""
    return df.unpivot(list(ids), list(columns), name, value)


def row_distances(
    matrix: DataFrame,
    row: str = "a",
    column: str = "b",
    value: str = "value",
    by: Sequence[str] = (),
) -> DataFrame:
    """Euclidean distance ``(a, b, distance)``, a < b, between the rows of a long matrix.

    Matrix rows are packed into arrays and dealt into blocks; every task compares
    two blocks of bounded size. Each row travels once for each block, not once
    for each other row; k rows give k(k-1)/2 distances. Cells meet by their column. A column that only one of two rows knows
    is left out of their sum, which is scaled up to the number of all columns; rows without a common column
    have a null distance.
    """
    known = matrix.where(F.col(value).isNotNull())
    cells = F.sort_array(F.collect_list(F.struct(F.xxhash64(column).alias("at"), F.col(value).cast("double").alias("v"))))
    width = known.groupBy(*by).agg(F.count_distinct(F.col(column)).alias("width"))
    packed = known.groupBy(*by, F.col(row).alias("row")).agg(cells.alias("cells"))
    packed = cut_lineage(
        _with_segment(packed, width, by).select(
            *by, "row", "width", F.col("cells.at").alias("at"), F.col("cells.v").alias("vector")
        )
    )
    # A row has as many cells as the matrix has columns; blocks are bounded in both.
    lengths = packed.groupBy(*by).agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("cells"))
    rows, cells_by_row = lengths.agg(F.max("rows"), F.max("cells")).first()
    blocks = math.ceil((rows or 1) / max(1, min(BLOCK_ROWS, BLOCK_CELLS // (cells_by_row or 1))))
    dealt = (
        packed.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
    )
    names = [packed.schema[name] for name in by]
    kind = packed.schema["row"].dataType
    schema = StructType(
        [*names, StructField("a", kind), StructField("b", kind), StructField("distance", DoubleType())]
    )
    segment = list(by)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = _aligned(pdf["at"].to_numpy(), pdf["vector"].to_numpy())
        width = int(pdf["width"].iloc[0])
        names_here = pdf["row"].to_numpy()
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        first = np.flatnonzero(pdf["block"].to_numpy() == low)
        second = np.flatnonzero(pdf["block"].to_numpy() == high)
        parts = []
        for at, i in enumerate(first):
            rest = second[at + 1 :] if low == high else second
            square = (vectors[rest] - vectors[i]) ** 2
            shared = (~np.isnan(square)).sum(axis=1)
            total = np.nansum(square, axis=1) * width / np.maximum(shared, 1)
            gap = np.sqrt(np.where(shared > 0, total, np.nan))
            parts.append(pd.DataFrame({"a": names_here[i], "b": names_here[rest], "distance": gap}))
        out = pd.concat(parts) if parts else pd.DataFrame({"a": [], "b": [], "distance": []})
        for name in segment:
            out[name] = pdf[name].iloc[0]
        return out[[*segment, "a", "b", "distance"]]

    found = dealt.groupBy(*by, "low", "high").applyInPandas(compare, schema)
    distance = F.when(~F.isnan("distance"), F.col("distance")).alias("distance")
    return found.select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), distance)


def _aligned(places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of cells as one matrix with a column for each place; a missing cell is not a number."""
    first = places[0]
    if all(len(p) == len(first) and np.array_equal(p, first) for p in places):
        return np.vstack(values).astype(float)
    columns = np.unique(np.concatenate(places))
    matrix = np.full((len(places), len(columns)), np.nan)
    for i, (place, value) in enumerate(zip(places, values)):
        matrix[i, np.searchsorted(columns, place)] = value
    return matrix


def complete_linkage(
    distances: DataFrame,
    by: Sequence[str] = (),
    local_members: int = LOCAL_MEMBERS,
    chain_members: int = LOCAL_MEMBERS,
) -> DataFrame:
    """Merge table ``(step, left, right, height, size)`` of complete-linkage clustering.

    A cluster goes by its smallest member; ``left < right``, and the merged
    cluster keeps the name ``left``. Equal heights merge in the order of
    (left, right). Segments of at most ``local_members`` members are merged in one
    task each; larger ones by rounds over the distance table, in each of which tasks merge parts of at most ``chain_members`` clusters.
    """
    distances = cut_lineage(distances.select(*by, "a", "b", "distance"))
    keys = [*by, "_all"]
    tagged = distances.withColumn("_all", F.lit(0))
    limit = local_members * (local_members - 1) // 2
    segments = tagged.groupBy(*keys).agg((F.count("*") > limit).alias("_large"))
    some, every = segments.agg(F.bool_or("_large"), F.bool_and("_large")).first()
    if not some:
        return _merge_in_tasks(tagged, by).drop("_all")
    if every:
        return _merge_in_rounds(tagged, by, chain_members).drop("_all")
    split = join_dimension(tagged, cut_lineage(segments), keys)
    small = split.where(~F.col("_large")).drop("_large")
    large = split.where("_large").drop("_large")
    return _merge_in_tasks(small, by).unionByName(_merge_in_rounds(large, by, chain_members)).drop("_all")


def _merge_in_tasks(tagged: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "_all"]
    kind = tagged.schema["a"].dataType
    schema = StructType(
        [
            *[tagged.schema[name] for name in keys],
            StructField("step", LongType()),
            StructField("left", kind),
            StructField("right", kind),
            StructField("height", DoubleType()),
            StructField("size", LongType()),
        ]
    )

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["a"]) | set(pdf["b"]))
        at = {name: i for i, name in enumerate(names)}
        k = len(names)
        gaps = np.full((k, k), np.inf)
        i, j = pdf["a"].map(at).to_numpy(), pdf["b"].map(at).to_numpy()
        gaps[i, j] = gaps[j, i] = pdf["distance"].to_numpy(float)
        size = np.ones(k, dtype=int)
        merges = []
        # The nearest of each row, the first of equal ones. Merging brings no clusters closer, so only rows whose
        # nearest took part in a merge look again.
        near = gaps.argmin(axis=1)
        least = gaps[np.arange(k), near]
        for step in range(1, k):
            # The first row of the smallest entry has the smallest names.
            left = int(least.argmin())
            right = int(near[left])
            height = gaps[left, right]
            size[left] += size[right]
            merges.append((step, names[left], names[right], height, size[left]))
            joined = np.maximum(gaps[left], gaps[right])
            joined[left] = np.inf
            gaps[left, :] = gaps[:, left] = joined
            gaps[right, :] = gaps[:, right] = np.inf
            again = np.flatnonzero((near == left) | (near == right))
            again = np.union1d(again, [left, right])
            near[again] = gaps[again].argmin(axis=1)
            least[again] = gaps[again, near[again]]
        out = pd.DataFrame(merges, columns=["step", "left", "right", "height", "size"])
        for name in keys:
            out[name] = pdf[name].iloc[0]
        return out[schema.names]

    return tagged.groupBy(*keys).applyInPandas(link, schema)


def _merge_in_rounds(tagged: DataFrame, by: Sequence[str], chain_members: int = LOCAL_MEMBERS) -> DataFrame:
    """Merge along chains of nearest clusters, many merges a round, until one cluster is left.

    Every cluster points to its nearest; clusters that point to each other in a chain or a tree of chains are a part. A
    task merges the nearest pairs of its part as long as no cluster outside can be nearer: with complete linkage a merge never brings
    clusters closer, so the distance to the nearest outside holds from below whatever the other parts do meanwhile. That
    gives the merges of the one-at-a-time order, which the heights restore. Parts have at most
    ``chain_members`` clusters; a chain in which every merge waits for the one before is one part. Each round writes its merges to one
    table, so the plan does not grow.
    """
    keys = [*by, "_all"]
    gaps = tagged
    weights = tagged.select(*keys, F.explode(F.array("a", "b")).alias("name")).distinct()
    weights = cut_lineage(weights.withColumn("w", F.lit(1).cast("long")))
    spark = tagged.sparkSession
    path, rounds = scratch_path(spark, "merges"), 0
    kind = tagged.schema["a"].dataType
    named = [tagged.schema[name] for name in keys]
    found = StructType(
        [
            *named,
            StructField("left", kind),
            StructField("right", kind),
            StructField("distance", DoubleType()),
            StructField("size", LongType()),
        ]
    )
    while not gaps.isEmpty():
        edge = F.struct("distance", "a", "b").alias("edge")
        ends = gaps.select(*keys, F.explode(F.array("a", "b")).alias("end"), edge)
        nearest = ends.groupBy(*keys, "end").agg(F.min("edge").alias("edge"))
        nearest = nearest.select(*keys, F.col("end").alias("name"), F.col("edge.a").alias("a"), F.col("edge.b").alias("b"), "edge.distance")
        # One row for each cluster, of as many pairs as their square.
        shape = StructType([*named, StructField("name", kind), StructField("_part", LongType()), StructField("_to", kind)])
        parts = nearest.groupBy(*keys).applyInPandas(_chains(keys, chain_members), shape)
        parts = cut_lineage(parts.join(weights, [*keys, "name"]), "parts")
        label = parts.select(*keys, "name", "_part")
        if fits_broadcast(label):
            label = F.broadcast(label)
        inside = gaps
        for end in ("a", "b"):
            inside = inside.join(label.withColumnsRenamed({"name": end, "_part": f"_part_{end}"}), [*keys, end])
        apart = inside.where("_part_a <> _part_b").select(*keys, F.explode(F.array("a", "b")).alias("name"), "distance")
        apart = apart.groupBy(*keys, "name").agg(F.min("distance").alias("out"))
        members = parts.join(apart, [*keys, "name"], "left")
        inside = inside.where("_part_a = _part_b").withColumn("_part", F.col("_part_a")).drop("_part_a", "_part_b")
        rounds += 1
        together = inside.groupBy(*keys, "_part").cogroup(members.groupBy(*keys, "_part"))
        together.applyInPandas(_merged_parts(keys), found).write.parquet(f"{path}/round={rounds}")
        merges = spark.read.schema(found).parquet(f"{path}/round={rounds}")
        moves = _final_names(merges, keys)
        if fits_broadcast(moves):
            moves = F.broadcast(moves)
        weights = _renamed(weights, "name", moves, keys).groupBy(*keys, "name").agg(F.sum("w").alias("w"))
        weights = cut_lineage(weights)
        moved = _renamed(_renamed(gaps, "a", moves, keys), "b", moves, keys)
        gaps = cut_lineage(
            moved.where(F.col("a") != F.col("b"))
            .groupBy(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            .agg(F.max("distance").alias("distance"))
            .withColumnsRenamed({"lo": "a", "hi": "b"})
        )
    if not rounds:
        merges = spark.createDataFrame([], found)
    else:
        merges = spark.read.schema(found).option("basePath", path).parquet(path)
    return numbered(merges, ["distance", "left", "right"], "step", keys).select(
        *keys, "step", "left", "right", F.col("distance").alias("height"), "size"
    )


def _chains(keys: list[str], most: int):
    """Parts of the graph in which every cluster points to its nearest, from rows (name, a, b, distance)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["distance", "a", "b"], kind="stable").reset_index(drop=True)
        at = {name: i for i, name in enumerate(pdf["name"])}
        to = np.where(pdf["name"] == pdf["a"], pdf["b"], pdf["a"])
        ahead = np.array([at[name] for name in to])
        # Edges get smaller along a chain, so each cluster comes after the one it points to, but for mutual pairs, which stay
        # together.
        part = np.full(len(pdf), -1)
        count: list[int] = []
        for i in range(len(pdf)):
            if part[i] >= 0:
                continue
            known = part[ahead[i]]
            if known < 0 or count[known] >= most:
                known = len(count)
                count.append(0)
            part[i] = known
            count[known] += 1
            if part[ahead[i]] < 0:
                part[ahead[i]] = known
                count[known] += 1
        out = pd.DataFrame({"name": pdf["name"], "_part": part, "_to": to})
        for name in keys:
            out[name] = pdf[name].iloc[0]
        return out[[*keys, "name", "_part", "_to"]]

    return run


def _merged_parts(keys: list[str]):
    """Merges of one part: rows (a, b, distance) inside it and its clusters (name, _to, w, out)."""

    def run(inside: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("name").reset_index(drop=True)
        names = members["name"].tolist()
        at = {name: i for i, name in enumerate(names)}
        k = len(names)
        gaps = np.full((k, k), np.inf)
        i, j = inside["a"].map(at).to_numpy(int), inside["b"].map(at).to_numpy(int)
        gaps[i, j] = gaps[j, i] = inside["distance"].to_numpy(float)
        size = members["w"].to_numpy(int)
        out = members["out"].fillna(np.inf).to_numpy(float)
        first = np.array([at.get(name, -1) for name in members["_to"]])
        places = np.arange(k)
        # Nearest among all clusters, by distance and names, as long as neither has merged.
        sure = (first >= 0) & (first[np.maximum(first, 0)] == places)
        near = gaps.argmin(axis=1)
        least = gaps[places, near]
        merges = []
        while True:
            free = (near[near] == places) & np.isfinite(least) & ((least < out) & (least < out[near]) | sure & (near == first))
            if not free.any():
                break
            left = int(np.where(free, least, np.inf).argmin())
            right = int(near[left])
            height = gaps[left, right]
            size[left] += size[right]
            merges.append((names[left], names[right], height, size[left]))
            joined = np.maximum(gaps[left], gaps[right])
            joined[left] = np.inf
            gaps[left, :] = gaps[:, left] = joined
            gaps[right, :] = gaps[:, right] = np.inf
            out[left] = max(out[left], out[right])
            sure[left] = sure[right] = False
            again = np.union1d(np.flatnonzero((near == left) | (near == right)), [left, right])
            near[again] = gaps[again].argmin(axis=1)
            least[again] = gaps[again, near[again]]
        found = pd.DataFrame(merges, columns=["left", "right", "distance", "size"])
        for name in keys:
            found[name] = members[name].iloc[0]
        return found[[*keys, "left", "right", "distance", "size"]]

    return run


def _final_names(merges: DataFrame, keys: list[str]) -> DataFrame:
    """(left, right): every cluster that went in a round, and the name of the one it is in now, by doubling the steps."""
    moves = cut_lineage(merges.select(*keys, "left", "right"), "moves")
    while True:
        far = moves.select(*keys, F.col("right").alias("left"), F.col("left").alias("_further"))
        ahead = moves.join(far, [*keys, "left"], "left")
        ahead = ahead.select(
            *keys, F.coalesce("_further", "left").alias("left"), "right", F.col("_further").isNotNull().alias("_moved")
        )
        ahead = cut_lineage(ahead, "moves")
        moves = ahead.drop("_moved")
        if ahead.where("_moved").isEmpty():
            return moves


def numbered(df: DataFrame, order: Sequence[str], name: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the 1-based place in ``order`` within each segment; ``order`` decides between any two rows.

    Rows are dealt by ranges and numbered within each; only counts by range reach a single task.
    """
    ranged = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*by, *order))
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(counts), "_range")
    placed = placed.withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
    placed = placed.drop("_range", "_before", "_inside")
    if not by:
        return placed
    first = placed.groupBy(*by).agg(F.min(name).alias("_first"))
    joined = _join_same(placed, first, by)
    return joined.withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")


def _renamed(df: DataFrame, column: str, moves: DataFrame, keys: list[str]) -> DataFrame:
    """Clusters named in ``column`` under their name after the merges of this round."""
    names = moves.withColumnsRenamed({"right": column, "left": "_to"})
    joined = df.join(names, [*keys, column], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_to")


def cut_clusters(
    merges: DataFrame,
    height: float,
    by: Sequence[str] = (),
    members: DataFrame | None = None,
    local_members: int = LOCAL_MEMBERS,
) -> DataFrame:
    """``(member, cluster)`` after keeping the merges up to ``height``.

    Clusters are numbered from 1 by their smallest member. A table of all
    ``members`` also covers a segment of just one, which has no merge. A tree of
    at most ``local_members`` is followed to its tops in one task, larger ones by
    joins.
    """
    keys = [*by, "_all"]
    tagged = cut_lineage(merges.withColumn("_all", F.lit(0)))
    largest = tagged.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    tops = _tops_in_tasks if largest < local_members else _tops_in_rounds
    found = tops(tagged, height, keys)
    if members is not None:
        alone = members.select(*by, F.lit(0).alias("_all"), "member", F.col("member").alias("top"))
        found = found.unionByName(alone).groupBy(*keys, "member").agg(F.min("top").alias("top"))
    if largest < local_members:
        # At most ``local_members`` rows of a segment.
        number = F.dense_rank().over(Window.partitionBy(*keys).orderBy("top"))
        return found.withColumn("cluster", number).select(*by, "member", "cluster")
    names = numbered(found.select(*keys, "top").distinct(), ["top"], "cluster", keys)
    names = names.withColumn("cluster", F.col("cluster").cast("int"))
    return _join_same(found, names, [*keys, "top"]).select(*by, "member", "cluster")


def _tops_in_tasks(tagged: DataFrame, height: float, keys: list[str]) -> DataFrame:
    kind = tagged.schema["left"].dataType
    schema = StructType(
        [*[tagged.schema[name] for name in keys], StructField("member", kind), StructField("top", kind)]
    )

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        top = {pdf["left"].min(): pdf["left"].min()}
        # From the root down, so that the left side is known before the right.
        for merge in pdf.sort_values("step", ascending=False).itertuples():
            top[merge.right] = top[merge.left] if merge.height <= height else merge.right
        out = pd.DataFrame({"member": list(top), "top": list(top.values())})
        for name in keys:
            out[name] = pdf[name].iloc[0]
        return out[schema.names]

    return tagged.groupBy(*keys).applyInPandas(follow, schema)


def _tops_in_rounds(tagged: DataFrame, height: float, keys: list[str]) -> DataFrame:
    """Every member points to where it was merged; pointers double until all reach a top."""
    up = F.when(F.col("height") <= height, F.col("left")).otherwise(F.col("right"))
    root = tagged.groupBy(*keys).agg(F.min("left").alias("member"))
    tops = tagged.select(*keys, F.col("right").alias("member"), up.alias("top")).unionByName(
        root.withColumn("top", F.col("member"))
    )
    tops = cut_lineage(tops)
    while True:
        jump = tops.select(*keys, F.col("member").alias("top"), F.col("top").alias("_next"))
        moved = cut_lineage(join_dimension(tops, jump, [*keys, "top"]))
        tops = moved.select(*keys, "member", F.col("_next").alias("top"))
        if moved.where(F.col("top") != F.col("_next")).isEmpty():
            return tops


def upper_merges(merges: DataFrame, height: float) -> DataFrame:
    """The part of the tree above ``height``."""
    return merges.where(F.col("height") > height)


def attach_cluster(
    df: DataFrame, clusters: DataFrame, group: str, name: str = "neighb_id", by: Sequence[str] = ()
) -> DataFrame:
    """Add the cluster number of each row's group; rows of other groups are dropped."""
    lookup = clusters.select(*by, F.col("member").alias(group), F.col("cluster").alias(name))
    return join_dimension(df, lookup, [*by, group])


def rank_components(scores: DataFrame, components: Sequence[str], group: str) -> DataFrame:
    """Components by how well they separate the groups: their F statistic, largest first.

    One pass computes the group statistics of all components.
    """
    known = scores.where(F.col(group).isNotNull()).dropna("any", subset=list(components))
    wide = known.groupBy(group).agg(
        F.count("*").alias("n"),
        *[F.avg(name).alias(f"mean_{name}") for name in components],
        *[F.coalesce(F.var_samp(name), F.lit(0.0)).alias(f"variance_{name}") for name in components],
    )
    parts = [
        F.struct(
            F.lit(name).alias("component"),
            F.col(f"mean_{name}").alias("mean"),
            F.col(f"variance_{name}").alias("variance"),
        )
        for name in components
    ]
    stats = cut_lineage(wide.select("n", F.explode(F.array(*parts)).alias("part")).select("n", "part.*"))
    return (
        anova_from_stats(stats, ["component"])
        .select("component", "f", "df_between", "df_within")
        .orderBy(F.desc("f"), "component")
    )
