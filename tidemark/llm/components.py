"""Connected components of a graph given by its edges, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reachable.

    Each round points the larger neighbours of a node at the smallest one, then the smaller ones (large and small
    star); trees flatten in a number of rounds that grows with the logarithm of the nodes. Rounds end when the
    set of edges no longer changes. Every round is written to the shared folder. Null ends are left out.
    """
    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    now = cut_lineage(now, "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the join below shuffles plainly and a node with very many edges can be split.
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        large = cut_lineage(large, "large")
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        star = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        now = cut_lineage(star.distinct(), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
