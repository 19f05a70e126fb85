"""Pieces against the library: ids, offsets, normalised texts and decoded ones."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import base, pieces, queries

from .conftest import TINY

PATH = public_tokenizers.path(queries.PIECES)
MARKS = " ▁\n\t\r aeiouxyzàéß　中文語😀🏽‍\0﻿Ａﬁ<0x0A></s><s>0123456789.,;'\"́"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts(documents):
    rng = random.Random(11)
    made = ["".join(rng.choices(MARKS, k=rng.randint(0, 150))) for _ in range(1500)]
    made += ["", " ", "▁", "  x  ", " x", "\n", "中" * 500, "ab" * 5000, "é" * 3000, " " * 4000 + "x"]
    return [text or "" for _, text in documents] + made


def test_ids_and_offsets_equal_the_library(library, texts):
    model = pieces.model(PATH)
    for text in texts:
        ids, starts, stops = model.encode(text)
        assert ids.tolist() == library.encode(text)
        want = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), stops.tolist(), strict=True)) == want
        assert int((stops - starts).sum()) == len(text.encode())


def test_long_texts_are_cut_where_no_piece_reaches_across(library, monkeypatch, texts):
    monkeypatch.setattr(pieces.parts, "__defaults__", (40,))
    model = pieces.model(PATH)
    for text in texts:
        ids, starts, stops = model.encode(text)
        assert ids.tolist() == library.encode(text)
        assert int((stops - starts).sum()) == len(text.encode())


def test_decoding_equals_the_library(library, texts):
    model = pieces.model(PATH)
    rng = random.Random(12)
    some = [[1, *library.encode(text), 2] for text in texts]
    kinds = [lambda: rng.randint(0, 2), lambda: rng.randint(3, 258), lambda: 29871, lambda: rng.randint(259, 31999)]
    some += [[rng.choice(kinds)() for _ in range(rng.randint(0, 9))] for _ in range(5000)]
    for ids in some:
        assert model.decode(np.array(ids, int)) == library.decode(ids)


@pytest.mark.parametrize("dummy,escape,squeeze", list(itertools.product((False, True), repeat=3)))
def test_longest_rules_and_their_sources_equal_the_library(dummy, escape, squeeze, texts):
    """The map of compatibility forms, with rules of several characters, against the library's own offsets."""
    rules = sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc_cf",
        add_dummy_prefix=dummy,
        escape_whitespaces=escape,
        remove_extra_whitespaces=squeeze,
    )
    model = pieces.Model(rules.serialized_model_proto())
    for text in texts[-800:]:
        text = text.replace("\0", "")
        chars, sources = model.normalise(text)
        want, offsets = rules.normalize(text, with_offsets=True)
        place = {int(b): i for i, b in enumerate(pieces.byte_starts(text))}
        assert chars == want
        assert [place[int(s)] for s in sources] == list(offsets)


def test_models_with_rules():
    """The same pieces under a map with rules, as another model would have them."""
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec()
    with open(PATH, "rb") as data:
        head = data.read()
    size = len(rules).to_bytes(3, "little")
    varint = bytes([size[0] & 127 | 128, (len(rules) >> 7) & 127 | 128, len(rules) >> 14])
    other = head + b"\x1a" + varint + rules
    model, same = pieces.Model(other), sentencepiece.SentencePieceProcessor(model_proto=other)
    for text in ("ﬁne Ａ1  b", "①②　x", "été ½", " ", "", "a\tb\nc"):
        ids, starts, stops = model.encode(text)
        assert ids.tolist() == same.encode(text)
        want = [(p.begin, p.end) for p in same.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), stops.tolist(), strict=True)) == want


def test_query_equals_the_library(spark, library, documents):
    got = {r["doc_id"]: r for r in base.QUERIES["op11_sentencepiece"](spark, TINY).collect()}
    assert len(got) == len(documents)
    for key, text in documents:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        row = got[key]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_on_odd_rows(odd, empty):
    found = pieces.encode(odd, PATH)
    rows = found.collect()
    assert len(rows) == odd.count()
    for row in rows:
        starts, stops = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["stops"], "<i8")
        assert len(starts) == len(stops) == row["n_tokens"]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {2}
    assert {r["decoded"] for r in rows if r["doc_id"] in (1, 2)} == {""}
    assert pieces.encode(empty, PATH).count() == 0
    clash = odd.withColumnRenamed("lang", "ids").withColumnRenamed("keep_id", "decoded")
    assert pieces.encode(clash, PATH).count() == odd.count()
