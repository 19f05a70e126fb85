"""Items are proposed by their rarest windows: the same pairs as by all, and no pairs for what all items share."""

from __future__ import annotations

import random
import time

import pytest

from tidemark.llm import base, decontaminate, queries  # noqa: F401

from .conftest import SOME

SHARED = "what is the value of the sum of 4 and 9 in the end"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    """Items that share windows, copies of items among them, whole and partial leaks, items of numbers and of one window."""
    rng = random.Random(7)
    items = [(i, f"{words(rng, rng.randint(1, 9))} {SHARED} {words(rng, rng.randint(0, 6))}") for i in range(60)]
    items += [(100 + i, items[i][1]) for i in range(5)]
    items += [(200, "3 + 4 * 5 - 6"), (201, "two words"), (202, SHARED), (203, "What is 5 km plus 7 km ?")]
    docs = []
    for i in range(150):
        some = rng.choice(items)[1].split()
        cut = some[: rng.randint(len(some) // 3, len(some))]
        docs.append((i, f"{words(rng, 8)}. {' '.join(cut)} {words(rng, 5)} {SHARED if i % 3 == 0 else ''}"))
    docs.append((None, items[0][1]))
    docs += [(900, items[3][1]), (900, "nothing of that kind"), (500, "3 + 4 * 5 - 6 and more")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("coverage", [0.2, 0.5, 0.9, 1.0])
def test_rarest_windows_propose_all_that_qualify(spark, tables, monkeypatch, coverage):
    few = {tuple(r) for r in decontaminate.matches(*tables, min_coverage=coverage).collect()}
    every = lambda items, each, totals, least: items.select("hash", "item").distinct()
    monkeypatch.setattr(decontaminate, "_rarest", every)
    assert few == {tuple(r) for r in decontaminate.matches(*tables, min_coverage=coverage).collect()}
    assert few


def test_query_equals_all_windows(spark, monkeypatch):
    few = {tuple(r) for r in base.QUERIES["op2_decontaminate"](spark, SOME).collect()}
    every = lambda items, each, totals, least: items.select("hash", "item").distinct()
    monkeypatch.setattr(decontaminate, "_rarest", every)
    assert few == {tuple(r) for r in base.QUERIES["op2_decontaminate"](spark, SOME).collect()}


def test_windows_that_all_items_share_bring_no_pairs(spark):
    rng = random.Random(1)
    items = [(i, f"{words(rng, 12)} {SHARED} {words(rng, 12)}") for i in range(1500)]
    docs = [(i, f"{words(rng, 12)} {SHARED} {words(rng, 12)}") for i in range(1500)]
    docs[3] = (3, items[9][1])
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    begun = time.time()
    found = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(3, 9)]
    assert time.time() - begun < 60


def test_rows_are_dropped_by_their_own_text(spark, tables):
    docs, items = tables
    left = decontaminate.remove(docs, items)
    assert left.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert None not in texts and texts[900] == "nothing of that kind"
    leaked = {r["doc_id"] for r in decontaminate.matches(docs, items).collect()}
    assert set(texts) == {r["doc_id"] for r in docs.collect()} - leaked - {None} | {900}
    clash = docs.selectExpr("doc_id", "text", "1 AS _row", "2 AS id", "3 AS hash", "4 AS _leak")
    assert decontaminate.remove(clash, items).columns == clash.columns
    assert decontaminate.remove(clash, items).count() == left.count()
