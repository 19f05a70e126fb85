"""Order statistics and ranks of a whole table without sorting it in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

SMALL_BRACKET = 50_000
SKETCH_ACCURACY = 10_000
# Even slots of a range; the ranges themselves are quantiles.
SLOT_BITS = 8
SLOTS = 1 << SLOT_BITS
# Rows of a range beyond which it is split again, and cuts that one pass puts into a range.
PART_ROWS = 1_000_000
RANGE_CUTS = 1_000


def _numbers(df: DataFrame, column: str) -> DataFrame:
    """The column as doubles ``v`` without what is no number."""
    known = df.select(F.col(column).cast("double").alias("v"))
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        known = known.where(~F.isnan("v"))
    return known


def _edges(known: DataFrame, guess: tuple[float, float] | None = None) -> tuple:
    """Count, least and greatest value, with a guess also the rows below it and up to its end."""
    first = [F.count("v"), F.min("v"), F.max("v")]
    if guess:
        first += [F.count_if(F.col("v") < guess[0]), F.count_if(F.col("v") <= guess[1])]
    return tuple(known.agg(*first).first())


def order_statistics(
    df: DataFrame,
    column: str,
    ranks: Sequence[int],
    guess: tuple[float, float] | None = None,
    edges: tuple | None = None,
) -> dict[int, float]:
    """Exact values at the given 0-based ``ranks`` of the known numbers in ``column``.

    Every rank has a bracket ``(low, high, rows below low, rows up to high)``. A
    quantile sketch proposes cuts inside the brackets, exact counts decide
    between which cuts each rank lies, and this repeats until the brackets are
    small enough to sort. A round is two partial aggregates for all ranks and
    shrinks the brackets by about the sketch accuracy; a value that fills many
    rows is settled or left behind in one round. A good ``guess`` of the bracket
    saves rounds and a bad one does no harm. Values are compared as doubles. ``edges`` is what
    :func:`_edges` found, if it was asked before.
    """
    value = F.col("v")
    known = _numbers(df, column)
    n, low, high, *around = edges or _edges(known, guess)
    wanted = sorted(set(ranks))
    if wanted and not 0 <= wanted[0] <= wanted[-1] < n:
        raise ValueError(f"ranks {wanted} do not fit {n} values")
    brackets = {rank: (low, high, 0, n) for rank in wanted}
    brackets |= {rank: (edge, edge, rank, rank + 1) for rank, edge in ((0, low), (n - 1, high)) if rank in brackets}
    if guess:
        below, upto = around
        brackets |= {rank: (*guess, below, upto) for rank in wanted if below <= rank < upto}
    found: dict[int, float] = {}
    while brackets:
        small: dict[tuple, list[int]] = {}
        for rank, bracket in list(brackets.items()):
            lo, hi, below, end = bracket
            if lo == hi:
                found[rank] = lo
            elif end - below <= SMALL_BRACKET:
                small.setdefault(bracket, []).append(rank)
            else:
                continue
            del brackets[rank]
        for (lo, hi, below, _), members in small.items():
            values = known.where(value.between(lo, hi)).agg(
                F.sort_array(F.collect_list("v")).alias("values")
            )
            picked = values.select(*[F.get("values", F.lit(rank - below)) for rank in members])
            found.update(zip(members, picked.first()))
        if brackets:
            brackets = _narrow(known, brackets)
    return found


def _narrow(known: DataFrame, brackets: dict[int, tuple]) -> dict[int, tuple]:
    """One sketch pass and one counting pass for all open brackets."""
    value = F.col("v")
    step = 2.0 / SKETCH_ACCURACY
    points: dict[tuple, set[float]] = {}
    for rank, (lo, hi, below, end) in brackets.items():
        at = (rank - below) / (end - below)
        points.setdefault((lo, hi), set()).update((max(0.0, at - step), at, min(1.0, at + step)))
    sketches = [
        F.percentile_approx(F.when(value.between(lo, hi), value), sorted(shares), SKETCH_ACCURACY)
        for (lo, hi), shares in points.items()
    ]
    cuts = sorted({cut for found in known.agg(*sketches).first() for cut in found})
    # Counts on and between the cuts; range 0 lies below the first, range i starts at cut i.
    ranges = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="v", outputCol="range"
    ).transform(known)
    at_cut = (F.col("range") > 0) & (
        F.get(F.array(*map(F.lit, cuts)), F.col("range").cast("int") - 1) == value
    )
    parts = (
        ranges.groupBy("range", (~at_cut).alias("inner"))
        .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .where("n > 0")
        .orderBy("range", "inner")
        .collect()
    )
    below, pieces = 0, []
    for part in parts:
        pieces.append((part.low, part.high, below, below + part.n))
        below += part.n
    narrowed = {}
    for rank, (lo, hi, below, end) in brackets.items():
        low, high, before, upto = next(piece for piece in pieces if piece[2] <= rank < piece[3])
        # A piece may reach beyond the bracket where no cut lies at its edge.
        if low < lo:
            low, before = lo, below
        if high > hi:
            high, upto = hi, end
        narrowed[rank] = (low, high, before, upto)
    return narrowed


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float]:
    """Exact quantiles of the known numbers, interpolated between neighbouring values."""
    edges = _edges(_numbers(df, column))
    n = edges[0]
    if not n:
        raise ValueError(f"no known values in {column}")
    spots = [share * (n - 1) for share in shares]
    ranks = {int(spot) for spot in spots} | {min(int(spot) + 1, n - 1) for spot in spots}
    values = order_statistics(df, column, sorted(ranks), edges=edges)
    result = []
    for spot in spots:
        low, high = values[int(spot)], values[min(int(spot) + 1, n - 1)]
        result.append(low + (high - low) * (spot - int(spot)))
    return result


def bounded_edges(known: DataFrame, edges: Sequence[float], part_rows: int) -> list[float]:
    """``edges`` with more of them, until each range holds at most ``part_rows`` of the numbers ``v``, or a single value.

    A range starts at its edge and ends before the next. Exact counts tell the crowded ones; each is cut at quantiles of its own
    rows, and a value that fills several of them is cut off from those above it. A pass counts the ranges that were
    crowded before, so the rest of the rows drops out. Every pass parts the values of a crowded range, wherever they lie.
    """
    edges = sorted(set(edges))
    open_rows = known
    while True:
        splits = [float("-inf"), *edges, float("inf")]
        ranges = Bucketizer(splits=splits, inputCol="v", outputCol="range").transform(open_rows)
        counts = ranges.groupBy("range").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        crowded = counts.where((F.col("n") > part_rows) & (F.col("low") < F.col("high"))).collect()
        if not crowded:
            return edges
        most = max(row.n for row in crowded)
        cuts = min(RANGE_CUTS, 2 * -(-most // part_rows) + 1)
        shares = [i / cuts for i in range(cuts + 1)]
        open_rows = ranges.where(F.col("range").isin([row.range for row in crowded]))
        found = open_rows.groupBy("range").agg(F.percentile_approx("v", shares, 10 * cuts).alias("cuts")).collect()
        open_rows = open_rows.drop("range")
        for row in found:
            hot = {a for a, b in zip(row.cuts, row.cuts[1:]) if a == b}
            edges += [*row.cuts, *(math.nextafter(v, math.inf) for v in hot)]
        edges = sorted({edge for edge in edges if math.isfinite(edge)})


def global_rank(
    df: DataFrame,
    order: str,
    tie: str | Sequence[str],
    name: str = "rank",
    buckets: int = 4096,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add the 1-based rank by the number ``order``; equal values follow the hash of ``tie``.

    Value ranges come from a quantile sketch and are fixed in the plan, so a
    recomputed task sees the same ranges. Ranges that turn out to hold more than ``part_rows`` rows are
    split again by their own counts, see :func:`bounded_edges`. Each is cut into ``SLOTS`` even slots. A
    value that is itself an edge gets a range of its own, whose slots follow the
    hash, because one value may hold any share of the rows. Only counts by slot
    reach a single task; rows are ranked inside their slot. Infinities lie beyond all edges. Rows without a value
    or with not-a-number keep a null rank.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    shares = [i / buckets for i in range(buckets + 1)]
    number = F.col(order).cast("double")
    number = F.when(~F.isnan(number), number)
    finite = F.when(F.abs(number) < float("inf"), number)
    cuts, total = df.agg(F.percentile_approx(finite, shares, 10 * buckets), F.count(finite)).first()
    edges = sorted(set(cuts or [0.0]))
    if total > part_rows:
        edges = bounded_edges(df.select(finite.alias("v")).where("v IS NOT NULL"), edges, part_rows)
    ranges = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="_number", outputCol="_range"
    ).transform(df.withColumn("_number", number)).drop("_number")
    # Range 0 lies below the first edge, range i starts at edge i, -1 is unknown.
    place = F.coalesce(F.col("_range").cast("int"), F.lit(-1))
    listed = F.array(*map(F.lit, edges))
    low, high = F.col("_low"), F.col("_high")
    # The share of the way from edge to edge never falls as the value grows.
    way = F.when(F.abs(F.col(order)) < float("inf"), F.floor((F.col(order) - low) / (high - low) * SLOTS))
    by_value = F.coalesce(F.least(way, F.lit(SLOTS - 1)), F.lit(0))
    by_hash = F.shiftrightunsigned("_hash", 64 - SLOT_BITS)
    marked = (
        ranges.withColumn("_range", place)
        .withColumns(
            {
                "_hash": F.xxhash64(*ties),
                "_low": F.when(F.col("_range") > 0, F.get(listed, F.col("_range") - 1)),
                "_high": F.when(F.col("_range") >= 0, F.get(listed, "_range")),
            }
        )
        .withColumn("_inner", (F.col("_range") >= 0) & ~F.coalesce(low == F.col(order), F.lit(False)))
        .withColumn("_slot", F.when(F.col("_inner"), by_value).otherwise(by_hash))
        .drop("_low", "_high")
    )
    parts = ["_range", "_inner", "_slot"]
    known = F.when(F.col("_range") >= 0, F.col("_n"))
    before = F.sum(known).over(Window.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1))
    # Two times SLOTS for each edge at most: the size of this table has a fixed bound.
    offsets = (
        marked.groupBy(*parts)
        .agg(F.count("*").alias("_n"))
        .select(*parts, F.coalesce(before, F.lit(0)).alias("_before"))
    )
    # Inside a slot of a single value the hash gives the order, inside the others the value does.
    inside = F.row_number().over(Window.partitionBy(*parts).orderBy(order, "_hash", *ties))
    rank = F.when(F.col("_range") >= 0, F.col("_before") + F.col("_place"))
    return (
        marked.withColumn("_place", inside)
        .join(F.broadcast(offsets), parts)
        .withColumn(name, rank)
        .drop(*parts, "_hash", "_before", "_place")
    )
