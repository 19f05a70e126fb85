"""A corpus from ``documents`` in five stages: toxicity, exact copies, near copies, benchmark leaks, packing.

Every stage reads what the one before it wrote and keeps the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact, simhash, toxicity
from tidemark.llm import queries as llm_queries
from tidemark.llm.base import table
from tidemark.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance doesn't place with the toxic ones."""
    model = llm_queries.toxicity_model(spark, sf_dir, docs)
    return toxicity.drop_toxic(docs, model)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS, stored=True)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), stored=True)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, as sequences of equal lengths."""
    return llm_queries.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("exact_dedup", copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", leaks),
    ("packing", packs),
]

#: Fingerprints, compression and tokens are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
