"""Spelling variants against a plain version that compares all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import base, queries, spelling  # noqa: F401

from .conftest import TINY


def plain_count(rows, least=6, min_count=5, slip=199):
    counts: Counter[str] = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip and mark % slip == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= min_count}


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def plain(rows, **options):
    """word -> (form, root, n, n_near, form_n), by all edits over all letters."""
    counts = plain_count(rows, **options)
    letters = sorted(set("".join(counts)))
    forms, near = {}, {}
    for word, n in counts.items():
        met = [w for w in edits(word, letters) if w in counts]
        near[word] = len(met)
        best = min(met, key=lambda w: (-counts[w], w.encode()), default=None)
        if best is not None and counts[best] >= 5 * n:
            forms[word] = best
    out = {}
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out[word] = (form, root, n, near[word], counts.get(form))
    return out


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark, documents):
    found = got(base.QUERIES["op12_spelling_variants"](spark, TINY))
    assert found == plain(documents)
    assert any(form for form, *_ in found.values())


@pytest.mark.parametrize("letters", ["abc", "abcdefghijklmnopqrstuvwxyzàéß"])
def test_dense_and_sparse_vocabularies(spark, letters):
    rng = random.Random(len(letters))
    words = ["".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(150)]
    for word in list(words):
        at = rng.randrange(len(word))
        words += [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:]]
    texts = [(i, " ".join(rng.choices(words, weights=[1 + 3000 // (j + 1) for j in range(len(words))], k=400))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = got(spelling.variants(docs))
    assert found == plain(texts)
    assert len({root for _, root, *_ in found.values()}) < len(found)


def test_chains_of_forms_are_followed(spark):
    rows = [(1, "aaaaaaa " * 5 + "aaaaaab " * 25 + "aaaaabb " * 125 + "aaaabbb " * 625 + "aaabbbb " * 3125)]
    found = got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), slip=None))
    assert found == plain(rows, slip=None)
    assert {root for _, root, *_ in found.values()} == {"aaabbbb"}


def test_every_one_edit_neighbour_is_met():
    rng = random.Random(3)
    for symbols in (4, 9):
        for length in (6, 11):
            words = ["".join(rng.choices("abcdefghijkl", k=length)) for _ in range(20)]
            keys: dict[int, set] = {i: set() for i in range(20)}
            for places, found in spelling.neighbours(words, symbols):
                for place, key in zip(places.tolist(), found.tolist(), strict=True):
                    assert key not in keys[place]
                    keys[place].add(key)
            for i, word in enumerate(words):
                for other in edits(word, "abcdefghijkl"):
                    assert int(spelling.keys_of([other], symbols)[0]) in keys[i]
                assert len(keys[i]) <= (2 * length + 1) * symbols + length + 1


def test_long_words_come_in_blocks(spark, monkeypatch):
    """Words longer than those carried, and than a block of places; what meets them is compared all the same."""
    monkeypatch.setattr(spelling, "HELD_KEYS", 500)
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefgh", k=200))
    edge = "x" * spelling.CARRIED
    rows = [(1, " ".join([long] * 30 + [long[:90] + long[91:]] * 6 + [long + "z"] * 5 + [edge] * 40 + [edge + "y"] * 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling.variants(docs, slip=None)) == plain(rows, slip=None)
    found = list(spelling.neighbours([long], 9))
    assert len(found) > 1
    keys = set(np.concatenate([k for _, k in found]).tolist())
    assert all(int(spelling.keys_of([w], 9)[0]) in keys for w in edits(long, "abc"))


def test_spelling_on_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(spelling.variants(odd)) == plain(rows)
    clash = odd.withColumnRenamed("lang", "word").withColumnRenamed("score", "n").withColumnRenamed("keep_id", "key")
    assert got(spelling.variants(clash)) == plain(rows)
    assert spelling.variants(empty).count() == 0
