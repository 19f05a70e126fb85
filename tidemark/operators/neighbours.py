"""Nearest rows of a table of queries: both sides in blocks, met by joins, pruned by bounds or by buckets.

Rows and queries are points (name, vec). Points of one cell lie together in blocks: one row with the names, in order, and the
matrix of the values. Joins move blocks, and a tile of two blocks is compared by products of matrices. Rows that no query can need
stay in the task that reads them: just those within a bound of some query are dealt into blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

#: Points in a block of rows and of queries, and cells of a matrix compared at a time.
ROW_BLOCK, QUERY_BLOCK, TILE_CELLS = 4096, 1024, 4_000_000
#: Neighbouring rows and queries of a tile that are told apart by a box, and numbers of a tile's exact distances held at a time.
LEAF, GROUP, PAIR_CELLS = 64, 64, 2_000_000
#: Distances to centres worked out at a time, in tasks and on the driver.
CENTER_CELLS = 500_000
#: Cells of the exact join and rows they are fitted to. Both bound what the driver holds, not which rows are compared.
MAX_CELLS, SAMPLE_ROWS = 1024, 8192
#: Cells that a query meets on average; with more of them the cells are made larger.
MOST_MET = 32
#: A sample that bounds distances has one row in so many, the sample before it one in so many of its rows.
PART = 32
#: Balls around queries, of common and of remote ones, and boxes around the balls, for points of up to so many values.
BALLS, FAR_BALLS, BOXES, BOX_WIDE = 128, 64, 3, 8
#: Buckets that a lookup opens are marked by their numbers' last bits.
SLOTS = 2**20
#: Least shares of a join's tasks, and queries that one task takes.
SHARES, TASK_QUERIES = 64, 8192
#: Blocks of queries whose bounds one task works out.
TASK_BLOCKS = 8
#: Rounding of distances, relative to the values.
SLACK = 1e-9

Cells = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def points(df: DataFrame, columns: Sequence[str] | str, key: str) -> DataFrame:
    """(name, vec): the complete rows; ``columns`` are numbers, or the name of one array of numbers."""
    return _complete(_named(df, columns, key))


def _named(df: DataFrame, columns: Sequence[str] | str, key: str) -> DataFrame:
    if isinstance(columns, str):
        vec = F.col(columns).cast("array<double>")
    else:
        vec = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.col(key).alias("name"), vec.alias("vec"))


def _complete(rows: DataFrame) -> DataFrame:
    # Null for an array that is null or has a null.
    return rows.where(~F.array_contains("vec", float("nan")))


def _asked(queries: DataFrame, columns: Sequence[str] | str, query_key: str) -> DataFrame:
    """The queries; repeated rows are one."""
    given = cut_lineage(_named(queries, columns, query_key), "queries")
    asked = _complete(given)
    if asked.count() < given.count():
        raise ValueError("a query row has a missing value")
    return asked.distinct()


def _least_keys(rows: DataFrame, k: int, rank: Callable[[], Column] = F.row_number) -> DataFrame:
    """Of equal points only the ``k`` smallest names can be an answer; tasks leave out the others before the shuffle."""
    # Hashes first: arrays have no prefix to sort by.
    rank = rank().over(Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("name"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _kept(rows: DataFrame) -> DataFrame:
    """Rows that are the same when they are read again: those of files, by projections and filters, as they are, others written."""

    def plain(plan: Any) -> bool:
        if plan.getClass().getSimpleName() == "LogicalRelation":
            return True
        below = plan.children()
        return plan.getClass().getSimpleName() in ("Project", "Filter") and plain(below.apply(0))

    plan = rows._jdf.queryExecution().optimizedPlan()
    return rows if plan.deterministic() and plain(plan) else cut_lineage(rows, "rows")


def _matrix(vec: pa.Array) -> np.ndarray:
    return np.asarray(vec.flatten(), float).reshape(len(vec), -1)


def _among(step: float) -> Column:
    """One row in ``step``: those of the smallest hashes."""
    return F.xxhash64("name", "vec") < int(2**64 / step) - 2**63


def _sample(rows: DataFrame, n: int, total: int | None = None) -> np.ndarray:
    """The ``n`` rows of ``total`` with the smallest hashes.

    Hashes are spread evenly, so a bound on them leaves about twice as many to rank; a task does that, and the driver gets ``n`` rows.
    """
    mark = F.xxhash64("name", "vec")
    share = 2 * n / max(1, rows.count() if total is None else total)
    while True:
        some = rows if share >= 1 else rows.where(_among(1 / share))
        drawn = cut_lineage(some.orderBy(mark).limit(n).select("vec"), "sample").toArrow()
        # Repeated rows share a hash, so there can be too few below the bound.
        if share >= 1 or drawn.num_rows >= n:
            return _matrix(drawn["vec"].combine_chunks()) if drawn.num_rows else np.zeros((0, 0))
        share *= 8


def _gaps(values: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Distance of every point to every centre."""
    square = values @ centers.T
    square *= -2
    square += (values**2).sum(axis=1)[:, None]
    square += (centers**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(square, 0.0, out=square), out=square)


def _nearest_centers(values: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centre nearest to every point and its distance, worked out for some points at a time."""
    home, gap = np.zeros(len(values), np.int64), np.zeros(len(values))
    some = max(1, CENTER_CELLS // len(centers))
    for first in range(0, len(values), some):
        gaps = _gaps(values[first : first + some], centers)
        best = home[first : first + some] = gaps.argmin(axis=1)
        gap[first : first + some] = gaps[np.arange(len(gaps)), best]
    return home, gap


# Blocks.


def in_leaves(values: np.ndarray, size: int) -> np.ndarray:
    """The places of the points, halved again and again along the widest side; every ``size`` of them are neighbours."""

    def halves(at: np.ndarray) -> list[np.ndarray]:
        if len(at) <= size:
            return [at]
        some = values[at]
        wide = some[:, (some.max(axis=0) - some.min(axis=0)).argmax()]
        cut = -(-len(at) // size) // 2 * size
        order = np.argpartition(wide, cut)
        return halves(at[order[:cut]]) + halves(at[order[cut:]])

    return np.concatenate(halves(np.arange(len(values))))


def blocks(rows: DataFrame, cells: Cells, size: int) -> DataFrame:
    """(block, cell, low, high, n, names, data, leaves) from points: each cell in blocks of up to ``size``, by their place in it.

    ``cells`` gives for a matrix the row, cell and place of every entry; a row may have entries in several cells. Entries are
    dealt by ranges of cell, place and a hash, so a cell that holds a third of them is split among tasks. ``leaves`` has the places
    of a block's points in an order in which neighbours lie together.
    """
    kind = rows.schema["name"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, cell, place = cells(_matrix(batch.column("vec")))
                taken = batch.take(pa.array(at))
                columns = [pa.array(cell, pa.int64()), pa.array(place, pa.float64()), *taken.columns]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "place", "name", "vec"])

    def block(cell: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        whole = whole.take(pc.sort_indices(whole["name"]))
        names, places = whole["name"].combine_chunks(), whole["place"].to_numpy()
        values = _matrix(whole["vec"].combine_chunks())
        row = [[cell], [places.min()], [places.max()], [len(names)]]
        listed = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
        packed = [values.tobytes(), in_leaves(values, LEAF).astype(np.int32).tobytes()]
        columns = [*(pa.array(x) for x in row), listed, *(pa.array([x], pa.binary()) for x in packed)]
        return pa.RecordBatch.from_arrays(columns, ["cell", "low", "high", "n", "names", "data", "leaves"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, count = None, [], 0
        for batch in batches:
            cell = np.asarray(batch.column("cell"))
            at = 0
            while at < len(cell):
                if held and (cell[at] != now or count == size):
                    yield block(now, held)
                    held, count = [], 0
                now = int(cell[at])
                same = int(np.searchsorted(cell[at:], now, side="right"))
                some = min(same, size - count)
                held.append(batch.slice(at, some))
                at, count = at + some, count + some
        if held:
            yield block(now, held)

    entries = rows.mapInArrow(assign, f"cell long, place double, name {kind}, vec array<double>")
    dealt = entries.repartitionByRange("cell", "place", F.xxhash64("name")).sortWithinPartitions("cell", "place")
    shape = f"cell long, low double, high double, n long, names array<{kind}>, data binary, leaves binary"
    return dealt.mapInArrow(gather, shape).withColumn("block", F.monotonically_increasing_id())


def _met(ours: DataFrame, theirs: DataFrame, *share: str) -> DataFrame:
    """Blocks of one cell. A query repeated for many cells is compressed to little, so Spark would take its blocks for a small table
    and send them through the driver."""
    return ours.hint("merge").join(theirs.hint("merge"), ["cell", *share])


def best_of(
    asked: np.ndarray, values: np.ndarray, k: int, limit: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, places and squared distances of the ``k`` nearest values of each query, ties by place.

    One product for many queries finds the values that can be among the best; their distances are then exact. With ``limit``, a
    squared distance for each query, values beyond it may be left out.
    """
    lengths = (values**2).sum(axis=1)
    some = max(1, TILE_CELLS // len(values))
    found = []
    for first in range(0, len(asked), some):
        part = asked[first : first + some]
        own = (part**2).sum(axis=1)
        rough = part @ values.T
        rough *= -2
        rough += lengths[None, :]
        rough += own[:, None]
        slack = SLACK * (own + lengths.max())
        most = np.full(len(part), np.inf) if limit is None else limit[first : first + some]
        near = rough <= (most + slack)[:, None]
        if len(values) > k and np.count_nonzero(near) > 16 * k * len(part):
            most = np.minimum(most, np.partition(rough, k - 1, axis=1)[:, k - 1])
            near = rough <= (most + slack)[:, None]
        ends = np.cumsum(np.count_nonzero(near, axis=1))
        at, pairs = 0, max(1, PAIR_CELLS // max(1, values.shape[1]))
        while at < len(part):
            # Equal values are all near, so a few queries may have many pairs.
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + pairs, side="right")))
            who, which = np.nonzero(near[at:to])
            gap = ((values[which] - part[at + who]) ** 2).sum(axis=1)
            order = np.lexsort((gap, who))
            who, which, gap = who[order], which[order], gap[order]
            best = np.arange(len(who)) - np.searchsorted(who, who) < k
            found.append((first + at + who[best], which[best], gap[best]))
            at = to
    who, which, gap = (np.concatenate(x) for x in zip(*found, strict=True))
    return who, which, gap


def best_within(
    asked: np.ndarray, bounds: np.ndarray, values: np.ndarray, order: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As :func:`best_of`, of values within ``bounds``: neighbouring queries are compared with the leaves whose boxes they reach."""
    starts, firsts = np.arange(0, len(order), LEAF), np.arange(0, len(asked), GROUP)
    placed, limit = values[order], bounds**2
    low, high = np.minimum.reduceat(placed, starts), np.maximum.reduceat(placed, starts)
    least, most = np.minimum.reduceat(asked, firsts), np.maximum.reduceat(asked, firsts)
    for first, from_, to in zip(firsts, least, most, strict=True):
        mine = slice(first, first + GROUP)
        away = np.maximum(np.maximum(low - to, from_ - high), 0.0)
        need = (away**2).sum(axis=1) <= limit[mine].max()
        if need.any():
            at = np.arange(len(order)) if need.all() else np.sort(order[np.repeat(need, LEAF)[: len(order)]])
            who, which, gap = best_of(asked[mine], values if need.all() else values[at], k, limit[mine])
            yield first + who, at[which], gap


def _tiles(met: DataFrame, k: int, query_kind: str, kind: str, bounded: bool = False) -> DataFrame:
    """(_query, _key, distance): the best of every tile (q_names, q_data, names, data).

    With ``bounded`` the last value of a query is the distance within which its answers lie, and tiles have ``leaves``.
    """
    wanted = ["q_names", "q_data", "names", "data", *["leaves"] * bounded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_names, q_data, names, data, *leaves in zip(*(batch.column(c) for c in wanted), strict=True):
                q_names, names = q_names.values, names.values
                asked = np.frombuffer(q_data.as_buffer(), float).reshape(len(q_names), -1)
                values = np.frombuffer(data.as_buffer(), float).reshape(len(names), -1)
                if bounded:
                    order = np.frombuffer(leaves[0].as_buffer(), np.int32)
                    found = list(best_within(np.ascontiguousarray(asked[:, :-1]), asked[:, -1], values, order, k))
                else:
                    found = [best_of(asked, values, k)]
                if found:
                    who, which, gap = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [q_names.take(pa.array(who)), names.take(pa.array(which)), pa.array(gap)], ["_query", "_key", "distance"]
                    )

    return met.select(*wanted).mapInArrow(run, f"_query {query_kind}, _key {kind}, distance double")


def _placed(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("_query").orderBy("distance", "_key"))
    return found.withColumn("place", place).where(F.col("place") <= k)


# The exact join.


def fit_centers(sample: np.ndarray, cells: int, rounds: int = 3) -> np.ndarray:
    """Centres of cells of a sample: every n-th row of it, moved to the mean of its cell a few times."""
    centers = np.unique(sample, axis=0)
    centers = centers[:: max(1, len(centers) // cells)][:cells]
    for _ in range(rounds):
        home, _ = _nearest_centers(sample, centers)
        counts = np.bincount(home, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, home, sample)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _homes(centers: np.ndarray) -> Cells:
    def cells(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.arange(len(values)), *_nearest_centers(values, centers)

    return cells


@dataclass(frozen=True)
class Rings:
    """What is known of the cells: centres, nearest and farthest row, number of rows. At most ``MAX_CELLS`` of them."""

    centers: np.ndarray
    low: np.ndarray
    high: np.ndarray
    n: np.ndarray

    def needed(self, asked: np.ndarray, home: int, bound: float | np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which cells can hold one of the ``k`` nearest rows of each query, the gaps to the centres and the bounds.

        All rows of a cell are within its farthest row of the centre; enough of them bound the k-th distance. A row of
        another cell lies beyond the plane halfway to that cell's centre.
        """
        gaps = _gaps(asked, self.centers)
        reach = gaps + self.high
        order = np.argsort(reach, axis=1)
        enough = np.cumsum(self.n[order], axis=1) >= k
        first = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
        rows = np.arange(len(asked))
        bounds = np.where(first >= 0, reach[rows, order[rows, first]], np.inf)
        bounds = np.minimum(bounds, bound)
        bounds = bounds + np.sqrt(SLACK) * (1 + np.sqrt((asked**2).sum(axis=1)) + np.abs(self.centers).max())
        apart = np.sqrt(((self.centers - self.centers[home]) ** 2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (gaps**2 - gaps[:, [home]] ** 2) / (2 * apart)
        plane = np.where(apart > 0, plane, 0.0)
        least = np.maximum(np.maximum(gaps - self.high, self.low - gaps), plane)
        return (least <= bounds[:, None]) & (self.n > 0), gaps, bounds


# Bounds of the distances, and rows beyond them.


def _bounded(asked: DataFrame, found: DataFrame, k: int, tasks: int) -> DataFrame:
    """The queries (name, vec, bound) with the distance of the ``k``-th row found where it is less than their bound."""
    kth = _placed(found.withColumn("_key", F.lit(0)), k).where(F.col("place") == k).select("_query", F.sqrt("distance").alias("kth"))
    met = asked.hint("merge").join(kth.hint("merge"), F.col("name").eqNullSafe(F.col("_query")), "left")
    return cut_lineage(met.select("name", "vec", F.least("bound", "kth").alias("bound")).repartition(tasks), "bounds")


def _bounded_by(asked: DataFrame, sample: np.ndarray, k: int) -> DataFrame:
    """The same from a sample of the rows."""
    if len(sample) < k:
        return asked
    lengths = (sample**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bound = _matrix(batch.column("vec")), np.asarray(batch.column("bound")).copy()
            some = max(1, TILE_CELLS // len(sample))
            for first in range(0, len(values), some):
                part = values[first : first + some]
                own = (part**2).sum(axis=1)
                rough = lengths[None, :] + own[:, None] - 2 * (part @ sample.T)
                kth = np.partition(rough, k - 1, axis=1)[:, k - 1] + SLACK * (own + lengths.max())
                bound[first : first + some] = np.minimum(bound[first : first + some], np.sqrt(np.maximum(kth, 0.0)))
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("vec"), pa.array(bound)], ["name", "vec", "bound"])

    return cut_lineage(asked.mapInArrow(run, asked.schema), "bounds")


def _boxes(low: np.ndarray, high: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """At most ``n`` boxes that hold all of these; the two whose common box adds least become one."""
    while len(low) > n:
        least, most = np.minimum(low[:, None], low[None]), np.maximum(high[:, None], high[None])
        own = (high - low).prod(axis=1)
        adds = (most - least).prod(axis=2) - own[:, None] - own[None]
        np.fill_diagonal(adds, np.inf)
        one, other = divmod(int(adds.argmin()), len(low))
        low[one], high[one] = least[one, other], most[one, other]
        low, high = np.delete(low, other, axis=0), np.delete(high, other, axis=0)
    return list(zip(low, high, strict=True))


def _in_reach(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows that lie within the bound of some query, and some others.

    Queries lie in balls around common centres; those that reach farthest beyond theirs have balls of their own. A ball's radius
    covers its queries' bounds. Few boxes around the balls leave rows out before these are sent to Python.
    """
    if not asked.where(F.col("bound") == float("inf")).isEmpty():
        return rows
    centers = fit_centers(_sample(asked, SAMPLE_ROWS), BALLS)
    wide = centers.shape[1]

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, gap = _nearest_centers(_matrix(batch.column("vec")), centers)
            yield pa.RecordBatch.from_arrays([pa.array(gap + np.asarray(batch.column("bound"))), batch.column("vec")], ["far", "vec"])

    farthest = asked.mapInArrow(far, "far double, vec array<double>").orderBy(F.desc("far")).limit(FAR_BALLS).select("vec").toArrow()
    balls = np.unique(np.concatenate([centers, _matrix(farthest["vec"].combine_chunks())]), axis=0)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, low, high = np.full(len(balls), -np.inf), np.full(balls.shape, np.inf), np.full(balls.shape, -np.inf)
        for batch in batches:
            values, bound = _matrix(batch.column("vec")), np.asarray(batch.column("bound"))
            home, gap = _nearest_centers(values, balls)
            np.maximum.at(most, home, gap + bound)
            np.minimum.at(low, home, values - bound[:, None])
            np.maximum.at(high, home, values + bound[:, None])
        seen = np.flatnonzero(most > -np.inf)
        ends = [pa.array(list(x[seen]), pa.list_(pa.float64())) for x in (low, high)]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(most[seen]), *ends], ["ball", "most", "low", "high"])

    covered = asked.mapInArrow(cover, "ball long, most double, low array<double>, high array<double>").groupBy("ball")
    sides = range(wide) if wide <= BOX_WIDE else ()
    ends = [end(F.col(name)[i]) for name, end in (("low", F.min), ("high", F.max)) for i in sides]
    found = np.array([tuple(r) for r in covered.agg(F.max("most"), *ends).collect()], float)
    balls, most = balls[found[:, 0].astype(int)], found[:, 1]
    slack = np.sqrt(SLACK) * (1 + np.sqrt((balls**2).sum(axis=1)) + most)
    most = most + slack
    if sides:
        boxes = _boxes(found[:, 2 : 2 + wide] - slack[:, None], found[:, 2 + wide :] + slack[:, None], BOXES)
        within = [[F.abs(F.get("vec", F.lit(i)) - float((low[i] + high[i]) / 2)) <= float((high[i] - low[i]) / 2) for i in sides] for low, high in boxes]
        rows = rows.where(reduce(or_, [reduce(and_, x) for x in within]))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("vec"))
            near, some = np.zeros(len(values), bool), max(1, CENTER_CELLS // len(balls))
            for first in range(0, len(values), some):
                near[first : first + some] = (_gaps(values[first : first + some], balls) <= most).any(axis=1)
            if near.any():
                yield batch.filter(pa.array(near))

    return rows.mapInArrow(keep, rows.schema)


def _cell_centers(rows: DataFrame, total: int, bounds: np.ndarray, k: int) -> np.ndarray:
    """Centres for the cells of the rows, no more than let a query of a sample, with its bound, meet few of them."""
    sample = _sample(rows, SAMPLE_ROWS, total)
    wanted = min(MAX_CELLS, max(1, int(total**0.5 / 2)))
    while True:
        centers = fit_centers(sample, wanted)
        if wanted <= MOST_MET:
            return centers
        home, gap = _nearest_centers(sample, centers)
        low, high = np.full(len(centers), np.inf), np.zeros(len(centers))
        np.minimum.at(low, home, gap)
        np.maximum.at(high, home, gap)
        n = np.bincount(home, minlength=len(centers))
        high[n == 0] = np.inf
        rings = Rings(centers, low, high, n)
        own, _ = _nearest_centers(bounds[:, :-1], centers)
        met = sum(rings.needed(bounds[own == i, :-1], int(i), bounds[own == i, -1], k)[0].sum() for i in np.unique(own))
        if met <= MOST_MET * len(bounds):
            return centers
        wanted //= 4


def _found(
    rows: DataFrame, asked: DataFrame, k: int, cells: int | None = None, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame | None:
    """(_query, _key, distance): rows within the bounds of the queries, with the ``k`` nearest of each; none if there are no rows."""
    kind, query_kind = (t.schema["name"].dataType.simpleString() for t in (rows, asked))
    rows = cut_lineage(_least_keys(_in_reach(rows, asked), k), "rows")
    total = rows.count()
    if not total:
        return None
    # The bound goes with a query as its last value.
    queries = asked.select("name", F.concat("vec", F.array("bound")).alias("vec"))
    if cells:
        centers = fit_centers(_sample(rows, SAMPLE_ROWS, total), cells)
    else:
        centers = _cell_centers(rows, total, _sample(queries, TASK_QUERIES // 32), k)
    homes = _homes(centers)
    theirs = cut_lineage(blocks(rows, homes, row_block), "row-blocks")
    ours = cut_lineage(blocks(queries, lambda values: homes(values[:, :-1]), query_block).select("cell", "names", "data"), "query-blocks")
    queried = ours.count()
    rings = _rings(theirs, centers)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for home, names, data in zip(*(batch.column(c) for c in ("cell", "names", "data")), strict=True):
                values = np.frombuffer(data.as_buffer(), float).reshape(len(names.values), -1)
                order = in_leaves(values[:, :-1], GROUP)
                names, values = names.values.take(pa.array(order)), values[order]
                need, gaps, bounds = rings.needed(values[:, :-1], home.as_py(), values[:, -1], k)
                for cell in np.flatnonzero(need.any(axis=0)):
                    some = np.flatnonzero(need[:, cell])
                    listed = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), names.take(pa.array(some)))
                    sent = np.column_stack([values[some, :-1], bounds[some]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(cell)]),
                            pa.array([float((gaps[some, cell] - bounds[some]).min())]),
                            pa.array([float((gaps[some, cell] + bounds[some]).max())]),
                            listed,
                            pa.array([sent.tobytes()], pa.binary()),
                        ],
                        ["cell", "least", "most", "q_names", "q_data"],
                    )

    shape = f"cell long, least double, most double, q_names array<{query_kind}>, q_data binary"
    # Blocks are few rows; each is work for a matrix.
    reached = ours.repartition(max(1, queried // TASK_BLOCKS)).mapInArrow(reach, shape)
    # Few cells are shared by several tasks, each with a part of the queries and all rows.
    shares = -(-SHARES // len(centers))
    reached = reached.withColumn("share", F.pmod(F.xxhash64("q_names"), F.lit(shares)))
    theirs = theirs.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    return _tiles(_met(reached, theirs, "share").where("high >= least AND low <= most"), k, query_kind, kind, bounded=True)


def nearest_join(
    df: DataFrame,
    queries: DataFrame,
    columns: Sequence[str] | str,
    key: str,
    query_key: str,
    k: int = 5,
    cells: int | None = None,
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
    known: DataFrame | None = None,
) -> DataFrame:
    """``(query_key, key, distance, place)``: the ``k`` nearest rows of every query row by squared distance, ties by key.

    Exact, with queries of any number: neither side is sent to all tasks or to the driver. First samples of the rows, each within
    the next, bound the k-th distance of every query: the first is compared as it is, the answers from each are the bounds
    for the next, those of the last for all rows. Rows beyond the bounds of all queries are left out where they are read. The others and
    the queries are dealt into cells around the same centres and into blocks by their distance from them; a block of queries meets just
    the blocks, and in them the leaves, that bounds by centre, ring, plane and box can't exclude. Centres are fitted to a
    bounded sample, which decides the speed only.

    ``known`` (_query, distance) may give distances of rows found already, instead of the samples. A query with a missing value is
    refused; rows with one are left out. Rows of equal values beyond the ``k`` smallest keys can't be answers and don't travel.
    """
    asked = _asked(queries, columns, query_key)
    rows = _kept(points(df, columns, key))
    query_kind = asked.schema["name"].dataType.simpleString()
    none = rows.limit(0).select(F.lit(None).cast(query_kind).alias("_query"), F.col("name").alias("_key"), F.lit(0.0).alias("distance"))
    count = asked.count()
    if not count:
        return _result(none, key, query_key, k)
    tasks = -(-count // TASK_QUERIES)
    asked = cut_lineage(asked.withColumn("bound", F.lit(float("inf"))).repartition(tasks), "bounds")
    if known is not None:
        asked = _bounded(asked, known, k, tasks)
    if known is None or not asked.where(F.col("bound") == float("inf")).isEmpty():
        part = cut_lineage(rows.where(_among(PART)), "part")
        drawn = part.count()
        enough = drawn >= SAMPLE_ROWS
        asked = _bounded_by(asked, _sample(part if enough else rows, SAMPLE_ROWS, PART * drawn if enough else None), k)
        steps = []
        while known is None and drawn > 4 * SAMPLE_ROWS:
            steps.append(PART ** (len(steps) + 1))
            drawn //= PART
        for step in reversed(steps):
            found = _found(part.where(_among(step)), asked, k)
            asked = asked if found is None else _bounded(asked, found, k, tasks)
    found = _found(rows, asked, k, cells, row_block, query_block)
    return _result(none if found is None else found, key, query_key, k)


def _rings(theirs: DataFrame, centers: np.ndarray) -> Rings:
    low, high, n = np.full(len(centers), np.inf), np.zeros(len(centers)), np.zeros(len(centers), np.int64)
    found = theirs.groupBy("cell").agg(F.min("low"), F.max("high"), F.sum("n")).collect()
    for cell, least, most, count in found:
        low[cell], high[cell], n[cell] = least, most, count
    high[n == 0] = np.inf
    return Rings(centers, low, high, n)


def _result(found: DataFrame, key: str, query_key: str, k: int) -> DataFrame:
    names: list[Column] = [F.col("_query").alias(query_key), F.col("_key").alias(key)]
    return _placed(found, k).select(*names, "distance", "place")


# The index.


@dataclass(frozen=True)
class Buckets:
    """Tables of buckets by random projections: a table has a few directions, each cut at quantiles of a sample.

    ``edges`` has one row of borders for each direction.
    """

    directions: np.ndarray  # tables x directions x values
    edges: np.ndarray  # tables x directions x borders

    def number(self, table: int, codes: np.ndarray) -> np.ndarray:
        cuts = self.edges.shape[2] + 1
        weights = cuts ** np.arange(codes.shape[-1])
        return table * cuts ** codes.shape[-1] + (codes * weights).sum(axis=-1)

    def codes(self, table: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strip of each value in each direction of a table, and where the value lies."""
        at, edges = values @ self.directions[table].T, self.edges[table]
        return np.stack([np.searchsorted(edges[i], at[:, i], side="right") for i in range(len(edges))], axis=1), at

    def own(self, values: np.ndarray) -> np.ndarray:
        """The bucket of each value in each table."""
        return np.stack([self.number(t, self.codes(t, values)[0]) for t in range(len(self.directions))])

    def cells(self, opened: np.ndarray | None = None) -> Cells:
        """The entries of rows; with ``opened`` those in buckets that it marks."""

        def cells(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            own = self.own(values)
            wanted = np.ones(own.shape, bool) if opened is None else _marked(opened, own)
            at = np.nonzero(wanted)[1]
            return at, own[wanted], np.zeros(len(at))

        return cells


def _marked(opened: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Which cells may be among those marked in the ``SLOTS`` bits of ``opened``."""
    slot = cell & (SLOTS - 1)
    return opened[slot >> 3] >> (slot & 7) & 1 == 1


@dataclass(frozen=True)
class NeighbourIndex:
    """Rows and the rule that puts each into one bucket of each table.

    The rule is small and the buckets are as large as the rows, once for each table. So they aren't stored: those that a lookup
    opens are made of the rows they hold, by one pass over the rows.
    """

    rows: DataFrame
    buckets: Buckets
    row_block: int
    key_kind: str

    @property
    def blocks(self) -> DataFrame:
        """All buckets of all tables."""
        return blocks(self.rows, self.buckets.cells(), self.row_block)

    def opened(self, asked: DataFrame, cells: Cells, k: int) -> DataFrame:
        """The buckets that entries of the queries by ``cells`` lie in, and some others.

        Of equal rows only those of the ``k`` smallest names are taken; the others can't be answers.
        """

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(SLOTS, bool)
            for batch in batches:
                seen[cells(_matrix(batch.column("vec")))[1] & (SLOTS - 1)] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], ["slot"])

        seen = np.zeros(SLOTS, bool)
        seen[np.asarray(asked.mapInArrow(slots, "slot long").distinct().toArrow()["slot"])] = True
        marks, buckets = np.packbits(seen, bitorder="little"), self.buckets

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = _marked(marks, buckets.own(_matrix(batch.column("vec")))).any(axis=0)
                if near.any():
                    yield batch.filter(pa.array(near))

        # Names, not rows, are counted: the same row found in two tables is one answer.
        rows = _least_keys(self.rows.mapInArrow(keep, self.rows.schema), k, F.dense_rank)
        return blocks(cut_lineage(rows, "opened"), buckets.cells(marks), self.row_block)


def build_index(
    df: DataFrame,
    columns: Sequence[str] | str,
    key: str,
    tables: int = 6,
    directions: int = 3,
    bucket: int = 1000,
    seed: int = 0,
    row_block: int = ROW_BLOCK,
) -> NeighbourIndex:
    """An index of the complete rows: ``tables`` tables of buckets of about ``bucket`` rows each.

    Borders come from a sample of ``SAMPLE_ROWS`` rows; all rows are indexed. A bucket has no greatest size: a full one is several blocks.
    Rows straight from files stay there, others are written once.
    """
    rows = _kept(points(df, columns, key))
    total = rows.count()
    sample = _sample(rows, SAMPLE_ROWS, total)
    wide = sample.shape[1] if len(sample) else 1
    directions = min(directions, wide)
    cuts = max(2, round((total / bucket) ** (1 / directions)))
    rng = np.random.default_rng(seed)
    lines = np.stack([np.linalg.qr(rng.normal(size=(wide, directions)))[0].T for _ in range(tables)])
    shares = np.arange(1, cuts) / cuts
    edges = np.zeros((tables, directions, cuts - 1))
    for t in range(tables if len(sample) else 0):
        edges[t] = np.quantile(sample @ lines[t].T, shares, axis=0).T
    return NeighbourIndex(rows, Buckets(lines, edges), row_block, rows.schema["name"].dataType.simpleString())


def nearest_index(
    index: NeighbourIndex,
    queries: DataFrame,
    columns: Sequence[str] | str,
    key: str,
    query_key: str,
    k: int = 5,
    probes: int = 8,
    exact: bool = False,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_key, key, distance, place)``: near rows of every query row, found in buckets and ranked by their exact distance.

    A query looks into ``probes`` buckets of each table: its own and those across the borders nearest to it. All rows are read once and
    those of the buckets looked into are dealt into blocks. An answer may miss a row
    that shares no bucket with the query. With ``exact`` the distances found are taken as bounds of :func:`nearest_join`, whose
    answer is complete. A query with a missing value is refused.
    """
    asked = _asked(queries, columns, query_key)
    query_kind = asked.schema["name"].dataType.simpleString()
    if index.rows.isEmpty():
        # Its directions are as wide as nothing.
        none = index.rows.select(F.lit(None).cast(query_kind).alias("_query"), F.col("name").alias("_key"), F.lit(0.0).alias("distance"))
        return _result(none, key, query_key, k)
    buckets = index.buckets
    lines, edges = buckets.directions, buckets.edges
    steps = np.array(list(product((-1, 0, 1), repeat=lines.shape[1])))

    def cells(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, found = [], []
        for t in range(len(lines)):
            codes, place = buckets.codes(t, values)
            cost = np.zeros((len(values), len(steps)))
            for i in range(lines.shape[1]):
                walls = np.concatenate([[-np.inf], edges[t, i], [np.inf]])
                to = np.stack([place[:, i] - walls[codes[:, i]], np.zeros(len(values)), walls[codes[:, i] + 1] - place[:, i]], axis=1)
                cost += to[:, steps[:, i] + 1] ** 2
            order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            open_ = np.isfinite(np.take_along_axis(cost, order, axis=1))
            who, which = np.nonzero(open_)
            at.append(who)
            found.append(buckets.number(t, codes[who] + steps[order[who, which]]))
        at = np.concatenate(at)
        return at, np.concatenate(found), np.zeros(len(at))

    asked = cut_lineage(asked.repartition(-(-max(1, asked.count()) // TASK_QUERIES)), "asked")
    theirs = index.opened(asked, cells, k).select("cell", "names", "data")
    ours = blocks(asked, cells, query_block).select("cell", F.col("names").alias("q_names"), F.col("data").alias("q_data"))
    # A row lies in a bucket of each table; a task keeps the best of a query, each once.
    place = F.dense_rank().over(Window.partitionBy("_query").orderBy("distance", "_key"))
    found = _tiles(_met(ours, theirs), k, query_kind, index.key_kind)
    found = found.withColumn("place", place).where(F.col("place") <= k).drop("place").distinct()
    if not exact:
        return _result(found, key, query_key, k)
    rows = index.rows.select(F.col("name").alias(key), F.col("vec").alias("_vec"))
    again = asked.select(F.col("name").alias(query_key), F.col("vec").alias("_vec"))
    return nearest_join(rows, again, "_vec", key, query_key, k, known=cut_lineage(found, "found"))


def recall(found: DataFrame, truth: DataFrame, key: str, query_key: str) -> float:
    """Share of the rows of ``truth`` that ``found`` has, too."""
    right = truth.select(query_key, key)
    return right.join(found.select(query_key, key), [query_key, key], "left_semi").count() / max(1, right.count())

