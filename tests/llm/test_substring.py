"""Edited passages around frequent phrases: how many the compact windows find at a similarity just above the limit."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa

from tidemark.llm import substring


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def edited(rng, words, word, least=0.8):
    """``words`` with single words changed, on either side of the middle, as long as the similarity stays at ``least``."""
    now = list(words)
    middle = len(words) // 2
    for side in [range(middle - 18, middle - 4), range(middle + 5, middle + 18)] * 4:
        trial = list(now)
        trial[rng.choice(side)] = word()
        if jaccard(words, trial) >= least:
            now = trial
    return now


def test_edited_passages_around_frequent_phrases_are_found(spark):
    """Each pair's passage holds one of three phrases that dozens of unrelated documents hold, too, the first of them."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvw", k=rng.randint(3, 9)))
    text = lambda n: [word() for _ in range(n)]
    phrases = [text(9) for _ in range(3)]
    rows = [(i, " ".join(text(60) + phrases[i % 3] + text(60))) for i in range(60)]
    pairs = []
    for i in range(80):
        passage = text(45) + phrases[i % 3] + text(46)
        copy = edited(rng, passage, word)
        assert 0.8 <= jaccard(passage, copy) < 1
        first, second = 1000 + 2 * i, 1001 + 2 * i
        rows.append((first, " ".join(text(50) + passage + text(40))))
        rows.append((second, " ".join(text(20) + copy + text(70))))
        pairs.append((first, second))
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    met = {frozenset((r["doc_id"], r["other_id"])) for r in found}
    share = sum(frozenset(p) in met for p in pairs) / len(pairs)
    assert share >= 0.95, share
    assert not any(k < 1000 for pair in met for k in pair)


def test_passages_of_different_lengths_and_edited_ends_are_found(spark):
    """Words put in, left out or changed anywhere, as long as the similarity stays at the limit: no pair is left out."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvw", k=rng.randint(3, 9)))
    text = lambda n: [word() for _ in range(n)]
    rows, pairs = [], []
    while len(pairs) < 150:
        passage = text(rng.choice([52, 55, 60, 80, 120]))
        copy = list(passage)
        for _ in range(40):
            trial, at, kind = list(copy), rng.randrange(len(copy)), rng.random()
            if kind < 0.4:
                trial[at] = word()
            elif kind < 0.7 and len(trial) > 50:
                del trial[at]
            else:
                trial.insert(at, word())
            if jaccard(passage, trial) >= 0.8:
                copy = trial
        first, second = 2 * len(pairs), 2 * len(pairs) + 1
        rows.append((first, " ".join(text(50) + passage + text(40))))
        rows.append((second, " ".join(text(20) + copy + text(70))))
        pairs.append((first, second))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substring.repeated_passages(df).collect()
    words = {i: t.split() for i, t in rows}
    for r in found:
        one, two = words[r["doc_id"]][r["start_word"] : r["end_word"]], words[r["other_id"]][r["other_start"] : r["other_end"]]
        assert min(len(one), len(two)) >= 50 and abs(jaccard(one, two) - r["similarity"]) < 1e-9 and r["similarity"] >= 0.8
    met = {frozenset((r["doc_id"], r["other_id"])) for r in found}
    assert not [p for p in pairs if frozenset(p) not in met]
    assert met <= {frozenset(p) for p in pairs}


def test_shingles_in_another_order_and_repeated_ones_are_aligned():
    a = np.array([7, 1, 2, 3, 9, 9, 4, 5, 8], "<u4")
    b = np.array([5, 1, 2, 3, 9, 4, 5, 9, 1], "<u4")
    i, j = substring._chain(a, b)
    assert list(i) == sorted(set(i)) and list(j) == sorted(set(j)) and list(a[i]) == list(b[j]) and len(i) == 5
    assert substring._aligned(a, b, 10, 0.8) is None
    p, q, u, v, alike = substring._aligned(a, b, 5, 0.8)
    one, two = set(a[p:q].tolist()), set(b[u:v].tolist())
    assert min(q - p, v - u) >= 5 and alike == len(one & two) / len(one | two) >= 0.8


def tree(h, least):
    """The nodes of the Cartesian tree over ``h`` one by one, the first of equal places above the others."""
    ranges, out = [(0, len(h))], []
    while ranges:
        a, b = ranges.pop()
        if b - a >= least:
            c = a + int(h[a:b].argmin())
            out.append((a, c, b - 1))
            ranges += [(a, c), (c + 1, b)]
    return sorted(out, key=lambda node: node[1])


def test_compact_windows_equal_the_tree_with_ties():
    rng = np.random.default_rng(9)
    for n, kinds, least in [(0, 5, 3), (2, 5, 3), (3, 1, 3), (50, 1, 7), (300, 4, 7), (300, 40, 1), (999, 2**63, 46), (400, 9, 64)]:
        h = rng.integers(0, kinds, n).astype(np.uint64)
        assert [tuple(w) for w in substring.compact_windows(h, least).tolist()] == tree(h, least)


def test_compact_windows_take_less_time_than_the_tree():
    """Place by place the tree of equal or rising hashes reads what is left once for each place."""
    h = np.concatenate([np.zeros(60_000, np.uint64), np.arange(60_000, dtype=np.uint64)])
    taken = []
    for find in (tree, substring.compact_windows):
        start = time.process_time()
        found = [tuple(int(x) for x in w) for w in find(h, 46)]
        taken.append((time.process_time() - start, sorted(found, key=lambda w: w[1])))
    assert taken[0][1] == taken[1][1] and taken[1][0] < taken[0][0] / 3


def test_windows_of_texts_found_together_are_those_of_each_text(monkeypatch):
    """Neither the texts beside one nor the number of windows gathered change its windows, contexts and ids."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefg" if i % 3 else "x", k=rng.choice([0, 3, 49, 50, 51, 120, 400]))) for i in range(60)]

    def windows(*rows):
        ids, texts = zip(*rows, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], ["id", "text"])
        return [r for b in substring._windows(46, 4)(iter([batch])) for r in b.to_pylist()]

    rows = list(enumerate(texts))
    alone = set()
    for i, text in rows:
        marks = substring.shingles(text)
        for f in range(4 if len(marks) >= 46 else 0):
            h = substring.permuted(marks, f)
            for low, c, high in tree(h, 46):
                context = substring.contexts(marks, np.array([c]), 0, len(marks))[0]
                alone.add((int(h[c].view(np.int64)), i, c, low, high, int(context)))
    for block, chunk in [(1, 1), (1 << 16, 1 << 19), (700, 90)]:
        monkeypatch.setattr(substring, "BLOCK", block)
        monkeypatch.setattr(substring, "CHUNK", chunk)
        found = {tuple(r[k] for k in substring.MEMBER) for r in windows(*rows) if not r["seed"]}
        # Some come again under their contexts; of a document's windows with one min-hash the first may stand for the others.
        assert {w[1:] for w in found} <= {w[1:] for w in alone} and {w[:2] for w in found} >= {w[:2] for w in alone}
