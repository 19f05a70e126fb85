"""Clashing names, repeated ids in samples, and plain versions of the scores."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import base, exact, language, queries, simhash, toxicity
from tidemark.llm.base import held_out

from .conftest import SOME


def clash(odd, *names):
    return odd.withColumns({name: F.lit(f"mine {name}") for name in names})


def test_exact_dedup_keeps_columns_of_any_name(odd):
    names = ["_tie", "_norm", "_slot0", "_maybe", "_first", "column_0", "block"]
    found = exact.exact_dedup(clash(odd, *names))
    assert found.columns == [c for c in [*odd.columns, *names] if c != "keep_id"] + list(exact.RESULT)
    assert found.select(*names).distinct().collect() == [tuple(f"mine {n}" for n in names)]
    want = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_dedup(odd).collect()}
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()} == want


def test_language_keeps_columns_of_any_name(odd):
    model = language.train(odd)
    found = language.identify(clash(odd, "_guess", "_Guess_"), model)
    assert [r["_guess"] for r in found.collect()] == ["mine _guess"] * odd.count()
    plain = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in found.collect()} == plain


def test_simhash_stage_keeps_columns_of_any_name(odd):
    names = ["_fp", "_row", "root", "stays", "_gone"]
    left = simhash.keep_one(clash(odd, *names))
    assert left.columns == [*odd.columns, *names]
    assert left.drop(*names).exceptAll(odd).isEmpty() and left.count() == simhash.keep_one(odd).count()


def test_a_repeated_id_is_one_document_of_a_sample(spark, monkeypatch):
    """Thousands of rows with one id neither multiply in the join nor outweigh the other documents."""
    words = {"xx": "abra cadabra simsala", "yy": "hocus pocus fidibus"}
    rows = [(i, words["xx" if i % 2 else "yy"] + f" {i}", "xx" if i % 2 else "yy") for i in range(60)]
    rows += [(1, "zzz qqq", "xx")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once = language.train(docs.dropDuplicates(["doc_id", "lang"]))
    model = language.train(docs)
    assert model.languages == ("xx", "yy")
    for lang, text in words.items():
        assert model.predict(text)[0] == once.predict(text)[0] == lang
    marks = spark.createDataFrame([(i, int(i % 2)) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda rows, prior: rows)
    assert len(toxicity.train(docs, marks)) == 60


def test_the_sample_has_a_bound_of_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, prior: seen.append(rows))
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    toxicity.train(docs, marks)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 1234)
    toxicity.train(docs, marks)
    assert [len(rows) for rows in seen] == [50, 12]


def test_scores_equal_a_plain_loop(spark):
    """Both scores over a table against the same model asked text by text, in plain Python and without Spark."""
    docs = spark.read.parquet(f"{SOME}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    model = language.train(docs.where(~held_out("doc_id")))
    found = {r["doc_id"]: r for r in base.QUERIES["op4_language_id"](spark, SOME).collect()}
    for row in rows:
        got = found[row["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        name, score = model.predict(row["text"])
        assert got["lang_pred"] == name and math.isclose(got["score"], score, abs_tol=1e-12)
    toxic = queries.toxicity_model(spark, SOME, docs)
    fresh = toxicity.Windows(toxic.toxic, toxic.ordinary)
    scored = {r["doc_id"]: r for r in base.QUERIES["op9_toxicity"](spark, SOME).collect()}
    for row in rows[:300]:
        x = (fresh.features(row["text"] or "") - np.array(toxic.centre)) / np.array(toxic.scale)
        z = toxic.weights[0] + sum(a * b for a, b in zip(x, toxic.weights[1:], strict=True))
        assert math.isclose(scored[row["doc_id"]]["score"], 1 / (1 + math.exp(-z)), rel_tol=1e-9)
        assert scored[row["doc_id"]]["predicted"] == int(scored[row["doc_id"]]["score"] >= 0.5)


def test_held_out_accuracy(spark):
    """Of documents that training hasn't seen."""
    docs = spark.read.parquet(f"{SOME}/documents.parquet").select("doc_id", "lang")
    found = base.QUERIES["op4_language_id"](spark, SOME).where("held_out").join(docs, "doc_id").where("lang IS NOT NULL")
    right = found.where("lang = lang_pred").count()
    assert right / found.count() >= 0.9
    marks = spark.read.parquet(f"{SOME}/labels.parquet").select("doc_id", "toxic")
    scored = base.QUERIES["op9_toxicity"](spark, SOME).where("held_out").join(marks, "doc_id")
    clean = scored.where("toxic = 0")
    assert clean.where("predicted = 0").count() / clean.count() >= 0.97


def test_rows_are_told_apart_by_their_place_in_files(spark, tmp_path, odd):
    """Repeated rows of several files: the same number wherever it is read, and nothing written; other tables are written once."""
    path = str(tmp_path / "docs")
    odd.repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    first, again = (base.numbered(docs, "n", stored=True).where("doc_id = 4").select("n") for _ in range(2))
    assert first.distinct().count() == 2 and first.exceptAll(again).isEmpty()
    assert base.numbered(docs, "n", stored=True).select("n").distinct().count() == docs.count()
    for table in (odd, docs):
        assert base.numbered(table, "n").select("n").distinct().count() == odd.count()
    stored, written = (simhash.keep_one(docs, stored=s) for s in (True, False))
    assert stored.count() == written.count() == simhash.keep_one(odd).count()
    assert stored.columns == docs.columns
