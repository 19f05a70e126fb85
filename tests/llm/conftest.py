from __future__ import annotations

import pytest

TINY = "/root/testdata/sf0.001"
SOME = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest tables."""
    return [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]


LONG = "the quick brown fox jumps over the lazy dog and then it sleeps under a tree for a very long time " * 4


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [
        (1, None, "en", 5, "x"),
        (2, "", "en", 5, None),
        (3, LONG, None, None, "x"),
        (4, LONG, "en", 5, "x"),
        (4, LONG, "en", 5, "x"),
        (5, "a  b\tc", "de", 5, "x"),
        (6, "a b c", "de", 5, "x"),
        (None, LONG + "tail", "en", 5, "x"),
        (None, "a b c", "en", 5, "x"),
        (7, "ab " * 100_000, "en", 5, "x"),
        (8, "é" * 3_000, "fr", 5, "x"),
        (9, "1234 !!! ...", "fr", 5, "x"),
        (10, "\n \t ", "fr", 5, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, keep_id string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
