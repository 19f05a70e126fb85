"""SimHash near-duplicates by an inverted index over the bytes of the fingerprints.

Two fingerprints of eight bytes that differ in d bits share at least 8 - d bytes at the same positions. With d up to
3 they share five or more, so three or more within one half of four; the index lists each fingerprint under
the four triples of positions of either half. Fingerprints that meet in a list have their shared positional bytes tallied,
pairs below the guaranteed minimum are discarded, the rest is verified by the number of differing bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import numbered, quoted, sheltered, small, text_of
from tidemark.llm.components import components
from tidemark.session import cut_lineage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Triples of byte positions within either half of a fingerprint.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Shingles whose bits are summed at a time, to bound memory on very long texts.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text as an unsigned number; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < shingle:
        starts, ends = np.array([0]), np.array([len(line)])
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of a text column as a signed long."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
        return pa.array(marks.view(np.int64))

    return run(text)


def _digits(mark: Column) -> Column:
    return F.lpad(F.lower(F.hex(mark)), 16, "0")


def _byte(mark: str, position: int) -> Column:
    return F.shiftrightunsigned(F.col(mark), 56 - 8 * position).bitwiseAND(F.lit(255).cast("long"))


def links(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) that differ in at most ``max_bits`` <= 3 bits.

    The tally and the check are part of the join's condition, so the pairs of a list never leave the join unless
    they link. A list that many fingerprints share is split by adaptive execution like any hot key.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees pairs of up to 3 differing bits")
    keys = []
    for i, triple in enumerate(TRIPLES):
        key = F.lit(i).cast("long")
        for position in triple:
            key = F.shiftleft(key, 8).bitwiseOR(_byte("fp", position))
        keys.append(key)
    lists = marks.select("fp", F.explode(F.array(*keys)).alias("list"))
    left = lists.select("list", F.col("fp").alias("a"))
    right = lists.select("list", F.col("fp").alias("b"))
    shared = sum((_byte("a", p) == _byte("b", p)).cast("int") for p in range(8))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(
        right,
        (left["list"] == right["list"]) & (F.col("a") < F.col("b")) & (shared >= 8 - max_bits) & (apart <= max_bits),
    )
    return pairs.select("a", "b").distinct()


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From (id, fp): one row per fingerprint with ``component_id``, ``links``, its number of links, and ``root``.

    ``root`` is a fingerprint that names the class. The class id is the smallest id reachable; null if no member has an id.
    """
    marks = prints.groupBy("fp").agg(F.min("id").alias("least"))
    edges = cut_lineage(links(marks.select("fp"), max_bits), "links")
    roots = components(edges)
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    linked = (
        marks.join(roots, marks["fp"] == roots["node"], "left")
        .drop("node")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").join(degree, F.col("fp") == degree["node"], "left")
    return linked.select("fp", "component_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"), "root")


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, fp) of every document with its class."""
    prints = docs.select(
        F.col(quoted(id_col)).alias("id"), fingerprint_column(text_of(text_col), shingle).alias("fp")
    )
    prints = cut_lineage(prints, "simhash")
    # Written, so that a fingerprint with very many documents can be split in the join.
    return prints.join(cut_lineage(classes(prints, max_bits), "classes"), "fp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``, ``links`` of its fingerprint.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer words than a shingle is one
    shingle; one without words, or null, has fingerprint zero and is linked like any other. Rows that repeat an id
    are kept each; rows without an id belong to a class but never name it. Only distinct fingerprints are indexed,
    so copies add no pairs. An empty table gives no rows.
    """
    found = _members(docs, id_col, text_col, shingle, max_bits)
    return found.select(
        F.col("id").alias(id_col),
        _digits(F.col("fp")).alias("fingerprint"),
        "component_id",
        "links",
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    stored: bool = False,
) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id, rows without an id last.

    Of rows of a class that share its smallest id, or have none, exactly one stays. With ``stored`` the rows of Parquet files are told
    apart by their places, see :func:`~tidemark.llm.base.numbered`; without it they are written once.
    """
    def keep(rows: DataFrame, id_name: str, text_name: str) -> DataFrame:
        marked = numbered(rows, "_row", stored)
        mark = fingerprint_column(text_of(text_name), shingle)
        prints = marked.select(F.col(id_name).alias("id"), mark.alias("fp"), F.col("_row").alias("row"))
        prints = cut_lineage(prints, "simhash")
        members = prints.join(cut_lineage(classes(prints, max_bits).select("fp", "root"), "classes"), "fp")
        order = F.struct(F.col("id").isNull().alias("without"), "id", "row")
        firsts = members.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        firsts = cut_lineage(firsts.where("n > 1").select("root", F.col("first.row").alias("stays")), "firsts")
        gone = members.join(small(firsts), "root").where("row <> stays").select(F.col("row").alias("_gone"))
        gone = small(cut_lineage(gone, "gone"))
        return marked.join(gone, F.col("_row") == F.col("_gone"), "left_anti")

    return sheltered(docs, [id_col, text_col], keep)
