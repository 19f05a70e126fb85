"""Every operator against a plain version, a round trip or held-out rows, and on odd rows."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import (
    base,
    components,
    decontaminate,
    exact,
    language,
    licences,
    packing,
    queries,
    simhash,
    substring,
    suffixes,
    toxicity,
)
from tidemark.llm import pages as web

from . import brute
from .conftest import LONG, SOME, TINY


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


# Exact copies.


def test_exact_equals_brute_force(spark, documents):
    found = base.QUERIES["op3_exact_dedup"](spark, TINY).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.exact(documents)
    assert len(found) == len(documents)


def test_exact_needs_no_python(spark):
    plan = base.QUERIES["op3_exact_dedup"](spark, TINY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_exact_on_odd_rows(odd, empty):
    found = exact.exact_dedup(odd)
    assert found.columns.count("keep_id") == 1
    kept = {r["doc_id"]: r["group_size"] for r in found.where("kept").collect()}
    assert kept == {1: 2, 3: 3, 5: 3, None: 1, 7: 1, 8: 1, 9: 1, 10: 1}
    assert found.count() == odd.count()
    assert exact.exact_dedup(empty).count() == 0


def test_exact_with_a_full_filter(odd):
    small = exact.exact_dedup(odd, max_bits=1).where("kept").count()
    assert small == exact.exact_dedup(odd).where("kept").count()


# SimHash.


def test_simhash_equals_brute_force(spark, documents):
    found = base.QUERIES["op5_simhash"](spark, TINY)
    got = {a: (b, c) for a, b, c in rows_of(found, "doc_id", "fingerprint", "component_id")}
    assert got == brute.near(documents)


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(4)
    marks = [rng.getrandbits(64) for _ in range(300)]
    for mark in marks[:150]:
        flips = rng.sample(range(64), rng.randint(1, 5))
        marks.append(mark ^ sum(1 << b for b in flips))
    signed = [m - (1 << 64) if m >> 63 else m for m in set(marks)]
    found = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long"))
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    want = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if near(a, b)}
    assert {tuple(r) for r in found.collect()} == want


def test_simhash_on_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd)
    got = rows_of(found, "doc_id", "fingerprint", "component_id")
    assert len(got) == odd.count()
    assert {c for k, f, c in got if f == "0" * 16} == {1}
    assert {c for k, _, c in got if k in (3, 4)} == {3}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert {1, 3, 5, 7, 8, 9} >= {r["doc_id"] for r in kept.collect() if r["doc_id"]}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_one_document_of_each_class_stays_whatever_the_ids(spark):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(400))
    lone, twice, both, other = text(), text(), text(), text()
    rows = [(None, lone), (None, lone + " "), (None, lone.replace(" ", "  ")), (1, twice), (1, twice + "\n")]
    rows += [(None, both), (2, both + " "), (2, both.upper()), (5, both), (3, other), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = simhash.keep_one(docs)
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower().split()[:1]) for r in kept.collect()) == sorted(
        (k, t.split()[:1]) for k, t in ((0, lone), (1, twice), (2, both), (3, other), (4, ""))
    )
    assert kept.exceptAll(docs).isEmpty()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    found = components.components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Packing.


def test_packing_is_a_round_trip(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    pieces = packing.pack(docs, *queries.tokenizer()).orderBy("doc_id", "start").collect()
    got: dict[int, list[int]] = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert p["start"] == len(got.setdefault(p["doc_id"], [])) and len(ids) == p["length"] == p["bucket"]
        assert p["offset"] == 0 and p["length"].bit_count() == 1 and p["length"] <= packing.MAX_TOKENS
        got[p["doc_id"]] += ids
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    assert got == {k: tokens.encode(t or "", add_special_tokens=False).ids + [1] for k, t in documents}
    digest = base.QUERIES["op6_packing"](spark, TINY).orderBy("doc_id", "start").collect()
    assert [r["ids_crc32"] for r in digest] == [zlib.crc32(p["ids"]) for p in pieces]


def test_packing_on_odd_rows(odd, empty):
    pieces = packing.pack(odd, *queries.tokenizer())
    assert {r["doc_id"] for r in pieces.collect()} == {None, *range(1, 11)}
    assert rows_of(pieces.where("doc_id = 1"), "start", "length", "doc_tokens") == [(0, 1, 1)]
    assert packing.pack(empty, *queries.tokenizer()).count() == 0


def test_long_texts_tokenize_in_parts():
    encode = packing.encoder(*queries.tokenizer()).encode_ordinary
    text = "".join(random.Random(1).choices(["a", " ", "  ", "\n", "b1", "'s", "é", ".", " x"], k=5_000))
    for size in (1, 7, 100):
        cut = list(packing.parts(text, size))
        assert "".join(cut) == text and [i for p in cut for i in encode(p)] == encode(text)


def test_lengths_are_powers_of_two():
    for n in range(1, 5_000, 7):
        cut = packing.lengths(n)
        assert sum(cut) == n and cut == sorted(cut, reverse=True) and all(c.bit_count() == 1 for c in cut)


# Suffixes.


def test_suffixes_equal_brute_force(spark, documents):
    found = base.QUERIES["op7_suffix_dedup"](spark, TINY)
    got = {r[0]: r[1:] for r in rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
    assert got == brute.cut(documents)


@pytest.fixture(scope="module")
def tangled():
    """Texts made of shared parts that meet at every kind of edge, of runs and of short periods."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcd", k=rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(rng.randint(5, 120))) for _ in range(12)]
    rows = []
    for key in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.6 else " ".join(word() for _ in range(20)) for _ in range(6)]
        if key % 10 == 0:
            parts.append("x" * rng.randint(90, 400))
        if key % 15 == 0:
            parts.append("ab c" * 200)
        rows.append((key, " ".join(parts)))
    return rows


@pytest.mark.parametrize("change", [{}, {"CHUNK": 64}, {"BLOCK": 130}, {"BUCKET": 1}, {"SORT_BYTES": 1}])
def test_suffixes_of_tangled_texts(spark, tangled, change, monkeypatch):
    if "BUCKET" in change:
        monkeypatch.setattr(suffixes, "BUCKET", 1)
    docs = spark.createDataFrame(tangled, "doc_id long, text string").repartition(5)
    if set(change) & {"CHUNK", "BLOCK", "SORT_BYTES"}:
        # Workers import the module anew: run the same steps here.
        for name, value in change.items():
            monkeypatch.setattr(suffixes, name, value)
        got = suffixes_here(tangled)
    else:
        cut = suffixes.remove_repeats(docs).collect()
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in cut}
    assert got == brute.cut(tangled)


def suffixes_here(rows):
    """The steps of the operator on plain rows, in two tasks."""
    import pyarrow as pa

    found = []
    for part in (rows[::2], rows[1::2]):
        batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in part]), pa.array([t for _, t in part])], ["key", "text"])
        found += [b for b in suffixes._contexts(iter([batch]))]
    whole = pa.Table.from_batches(found).sort_by([(c, "ascending") for c in ("anchor", "context", "key", "place")])
    order = whole.to_pylist()
    order.sort(key=lambda r: (r["anchor"] is not None, r["anchor"] or 0, r["context"], r["key"], r["place"]))
    table = pa.Table.from_pylist(order, whole.schema)
    batches = [b for i in range(0, len(order), 37) for b in table.slice(i, 37).combine_chunks().to_batches()]
    met = [r for b in suffixes._repeats(iter(batches)) for r in b.to_pylist()]
    gone = [(r["key"], r["place"], r["n"]) for r in met if r["anchor"] is None]
    texts = {k: t.encode() for k, t in rows}
    block = []
    for r in sorted((r for r in met if r["anchor"] is not None), key=lambda r: r["anchor"]):
        data, start = texts[r["key"]], r["place"] & 0xFFFFFFFF
        leads = {f: p - f for _, fs, _, ps in suffixes.anchors(data) for f, p in zip(fs.tolist(), ps.tolist(), strict=True)}
        block.append((r["anchor"], r["key"], r["place"], r["n"], leads[start], data[start : start + r["n"] + 99]))
    names = ["anchor", "key", "place", "n", "lead", "data"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*block, strict=True), kinds, strict=True)]
    whole = pa.RecordBatch.from_arrays(columns, names)
    for b in suffixes._sorted(iter([whole.slice(i, 23) for i in range(0, whole.num_rows, 23)])):
        gone += [(r["key"], r["place"], r["n"]) for r in b.to_pylist()]
    out = {}
    for key, data in texts.items():
        mark = bytearray(len(data))
        for _, place, n in (g for g in gone if g[0] == key):
            start = place & 0xFFFFFFFF
            mark[start : start + n + 99] = b"\1" * (n + 99)
        kept = bytes(c for c, g in zip(data, mark, strict=True) if not g)
        out[key] = (len(data), sum(mark), len([1 for a, b in itertools.groupby(mark) if a]), brute.sha(kept))
    return out


def test_suffixes_on_odd_rows(odd, empty):
    found = suffixes.remove_repeats(odd)
    got = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in found.collect()}
    assert got[(3, len(LONG))] == brute.cut([(3, LONG)])[3][1] and got[(4, len(LONG))] == len(LONG) and got[(1, 0)] == 0
    assert got[(None, len(LONG) + 4)] >= len(LONG) and got[(8, 6_000)] == 5_998
    assert found.count() == odd.count() and suffixes.remove_repeats(empty).count() == 0


def test_difference_cover_reaches_every_residue():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


# Passages.


def test_compact_windows_cover_every_subsequence():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 50, 60).astype(np.uint64)
    windows = list(substring.compact_windows(h, 7))
    for a in range(60):
        for b in range(a + 6, 60):
            held = [c for l, c, r in windows if l <= a <= c <= b <= r]
            assert len(held) == 1 and h[held[0]] == h[a : b + 1].min()


def test_planted_passages_are_found(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    text = lambda n: [word() for _ in range(n)]
    passage, other = text(60), text(80)
    edited = [*other]
    edited[40] = "changed"
    rows, place = [], {}
    for key in range(40):
        before = text(rng.randint(0, 300))
        planted = passage if key % 4 == 0 else other if key % 4 == 1 else edited if key == 2 else []
        place[key] = (len(before), len(planted))
        rows.append((key, " ".join(before + planted + text(rng.randint(0, 200)))))
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    by = {r["doc_id"]: r for r in found}
    assert set(by) == {k for k in range(40) if k % 4 < 2} - {0, 1} | {2}
    for key, r in by.items():
        start, n = place[key]
        assert r["class_id"] == (0 if key % 4 == 0 else 1) and r["similarity"] >= 0.8
        assert abs(r["start_word"] - start) <= 12 and abs(r["end_word"] - start - n) <= 12


def test_runs_inside_an_edited_copy_are_found(spark):
    rng = random.Random(11)
    text = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    edited = [w if i % 14 or 150 <= i < 230 else "x" + w for i, w in enumerate(text)]
    rows = [(1, " ".join(text)), (2, " ".join(edited))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert any(r["start_word"] <= 155 and r["end_word"] >= 225 and r["similarity"] >= 0.8 for r in found)


def test_passages_of_real_documents_by_brute_force(spark):
    words = 51
    docs = rows_of(spark.read.parquet(f"{SOME}/documents.parquet"), "doc_id", "text")
    where: dict[bytes, set[int]] = {}
    for key, text in docs:
        w = (text or "").lower().encode().split()
        for i in range(len(w) - words + 1):
            where.setdefault(b" ".join(w[i : i + words]), set()).add(key)
    found = base.QUERIES["op1_substring_dedup"](spark, SOME).collect()
    root = {k: r["class_id"] for r in found for k in (r["doc_id"], r["other_id"])}
    shared = [s for s in where.values() if len(s) > 1]
    met = [s for s in shared if len({root.get(k, -k - 1) for k in s}) == 1]
    assert len(met) / len(shared) > 0.99 and len(shared) > 1_000


def test_clean_documents_have_no_passages(spark):
    rng = random.Random(8)
    rows = [(k, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(300))) for k in range(30)]
    assert substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_passages_on_odd_rows(odd, empty):
    found = rows_of(substring.repeated_passages(odd), "doc_id", "class_id")
    assert (4, 3) in found and all(k in (3, 4) for k, _ in found)
    assert substring.repeated_passages(empty).count() == 0


# Benchmark.


def test_leaks_equal_brute_force(spark):
    docs = rows_of(spark.read.parquet(f"{SOME}/documents.parquet"), "doc_id", "text")
    items = rows_of(spark.read.parquet(f"{SOME}/benchmark.parquet"), "item_id", "text")
    flat = lambda t: f" {' '.join((t or '').lower().split())} "
    texts = [(k, flat(t)) for k, t in docs]
    want = {(k, i) for i, b in items for k, t in texts if flat(b) in t}
    got = rows_of(base.QUERIES["op2_decontaminate"](spark, SOME), "doc_id", "item_id")
    assert set(got) >= want and len(set(got)) == len(got) and len(want) > 10
    # The others hold most of an item, next to words that the plain comparison takes as part of it.
    for key, item in set(got) - want:
        words = flat(dict(items)[item]).split()
        middle = " ".join(words[len(words) // 4 : -len(words) // 4])
        assert middle in dict(texts)[key]


QUESTION = "A train leaves Boston at 9 and travels 120 km in 2 hours. How many km does the train to Boston travel in 5 hours?"


def test_changed_values_are_caught_and_must_agree(spark, odd, empty):
    swapped = QUESTION.replace("Boston", "Denver").replace("120", "340").replace("9", "7")
    mixed = QUESTION.replace("to Boston", "to Chicago").replace("leaves Boston", "leaves Denver")
    rows = [
        (1, f"Notes of the day. {swapped} It was asked again."),
        (2, QUESTION.upper()),
        (3, "A train leaves the city at 9 and nobody knows how far it went in the end."),
        (4, mixed),
        (5, None),
        (6, ""),
    ]
    items = spark.createDataFrame([(1, QUESTION), (2, None), (3, ""), (None, QUESTION)], "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), items)
    got = {r["doc_id"]: r for r in found.collect()}
    assert set(got) >= {1, 2} and 3 not in got
    assert got[1]["coverage"] == 1.0 and got[1]["changed"] == 3
    assert 4 not in got or got[4]["coverage"] < 1.0
    left = decontaminate.remove(odd, items)
    assert left.count() == odd.count() and left.columns == odd.columns
    assert decontaminate.remove(empty, items).count() == 0
    assert decontaminate.matches(odd, items.limit(0)).count() == 0


def test_every_variant_of_a_question_is_judged_on_its_own(spark):
    item = "If 3 boys and 4 girls buy 5 pens"
    variants = [item.replace("3", a).replace("4", b).replace("5", c) for a, b, c in ("729", "816", "648")]
    added = item.replace("girls", "more girls")
    rows = [
        (1, f"{item}. {variants[0]}."),
        (2, ". ".join([*variants, item, *variants])),
        (3, f"{variants[0]} or {variants[1]}"),
        (4, f"{variants[0]}. {added}. {variants[1]}"),
        (5, "If 3 boys run. And 4 girls buy 6"),
    ]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    got = {r["doc_id"]: (r["coverage"], r["changed"]) for r in found}
    assert set(got) == {1, 2, 3, 4} and len(found) == 4
    assert got[1] == got[2] == (1.0, 0) and got[3] == (1.0, 3) and got[4][0] >= 0.5


def test_names_that_start_sentences_are_slots_too(spark):
    item = "Tom has 3 apples. Tom eats 2. How many are left?"
    rows = [
        (1, item.replace("Tom", "Sam")),
        (2, item.replace("Tom", "Sam").replace("2", "1") + " " + item.replace("Tom", "Ann")),
        (3, "Yesterday Sam has 3 apples, Sam eats 2, how many are left?"),
        (4, item.lower()),
        (5, "Sam has 3 pears. Ann reads 2 books. Nobody knows how few are here."),
    ]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    got = {r["doc_id"]: (r["coverage"], r["changed"]) for r in found}
    assert set(got) == {1, 2, 3, 4}
    assert got[1] == got[2] == (1.0, 1) and got[3] == (1.0, 1) and got[4] == (1.0, 0)


def test_windows_of_numbers_are_met_by_value(spark):
    items = [(1, "Compute 12 + 7 * 3 - 9."), (2, "Add 1, 2, 3, 4, 5, 6 and 7 and then halve the sum")]
    rows = [
        (1, "It says: compute 12 + 7 * 3 - 9, and nothing more."),
        (2, "Compute 12 + 7 * 3 - 8."),
        (3, items[1][1]),
        (4, items[1][1].replace("6", "9").replace("7", "8")),
        (5, "1, 2, 3, 4, 5, 6 and 7"),
    ]
    found = decontaminate.matches(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    got = {(r["doc_id"], r["item_id"]): (r["windows"], r["coverage"], r["changed"]) for r in found.collect()}
    assert got[1, 1] == (1, 1.0, 0) and got[3, 2] == (10, 1.0, 0) and (2, 1) not in got
    assert got[4, 2][1] == 1.0 and got[4, 2][2] == 2


def test_short_items_are_one_window(spark):
    items = spark.createDataFrame([(1, "zig zag zug")], "item_id long, text string")
    rows = spark.createDataFrame([(1, "and zig zag zug too"), (2, "zig zag and zug")], "doc_id long, text string")
    assert rows_of(decontaminate.matches(rows, items), "doc_id") == [(1,)]


# Languages.


def test_languages_of_held_out_documents(spark):
    found = base.QUERIES["op4_language_id"](spark, SOME)
    docs = spark.read.parquet(f"{SOME}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) > 0.95
    assert len(rows) == docs.count()


def test_languages_of_odd_rows(spark, odd, empty):
    model = language.train(odd)
    got = {(r["doc_id"], r["text"]): r["lang_pred"] for r in language.identify(odd, model).collect()}
    assert got[(1, None)] == got[(2, "")] == got[(9, "1234 !!! ...")] == "und" != got[(4, LONG)]
    assert language.identify(empty, model).count() == 0
    none = language.train(empty)
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}


def test_filter_returns_every_language_of_an_ngram():
    grams = [np.array([5, 9, 1 << 60], np.uint64), np.array([9, 77], np.uint64)]
    words = language._filled(grams)
    model = language.Model(("a", "b"), words, np.zeros(2), np.ones(2), 0)
    assert model.sets(np.array([5, 9, 77, 1 << 60], np.uint64))[:, 0].tolist() == [1, 3, 2, 1]


# Pages.


def test_main_text_equals_the_articles(spark):
    import html
    import re

    pages = rows_of(spark.read.parquet(f"{SOME}/pages.parquet"), "page_id", "html")
    want = {}
    for key, page in pages:
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
        blocks = [re.sub(r"<[^>]*(>|$)", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        want[key] = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
    found = base.QUERIES["op8_html_text"](spark, SOME).collect()
    assert {r["page_id"]: r["text"] for r in found} == want
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_messages_equal_enumeration():
    rng = random.Random(2)
    parents = [-1, 0, 0, 1, 1, 2, 3]
    bias = [rng.uniform(-2, 2) for _ in parents]
    edges = [[[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)] for _ in range(3)]
    kind = [0, 1, 2, 0, 1, 2, 0]
    weight = {}
    for states in itertools.product((0, 1), repeat=7):
        x = sum(b * s for b, s in zip(bias, states, strict=True)) + sum(
            edges[kind[i]][states[parents[i]]][states[i]] for i in range(1, 7)
        )
        weight[states] = np.exp(x)
    total = sum(weight.values())
    belief, up, sent = web.messages(parents, bias, edges, kind)
    for i in range(7):
        p = sum(w for s, w in weight.items() if s[i]) / total
        assert abs(belief[i] - np.log(p / (1 - p))) < 1e-9
    pairs = web.pair_marginals(parents, edges, kind, belief, up, sent)
    want = sum(w for s, w in weight.items() for i in range(1, 7) if s[parents[i]] and s[i]) / total
    assert abs(sum(p[1][1] for p in pairs) - want) < 1e-9


@pytest.mark.parametrize(
    "part",
    [
        '<div class="cookie-notice">We use cookies to make this site work better for you.</div>',
        "<form><p>Sign up here for more of this every single day.</p></form>",
        '<section id="comments"><p>I do not agree with anything that was written here at all.</p></section>',
        "<aside><p>Read these other stories that we picked for you today.</p></aside>",
        "<header><p>The daily paper of the whole region since long ago.</p></header>",
        '<div class="ad"><p>Buy one of these now and get another one for free.</p></div>',
        "<script>var a = '<p>no text</p>';</script><style>p { margin: 0 }</style><!-- <p>no</p> -->",
    ],
)
def test_parts_that_are_no_content(part):
    body = f"<article><h1>A &amp; B</h1><p>{LONG}</p><p>Short&nbsp;one</p></article>"
    got = list(map(web.Extractor(web.default_model()).text, [f"<body>{part}{body}</body>", f"<body>{body}{part}</body>"]))
    assert got == ["A & B\n\n" + LONG.strip() + "\n\nShort one"] * 2


@pytest.mark.parametrize(
    "raw",
    [
        "<script>for(i=0;i<n;i++){f(i)}</script>",
        "<script>if(a<b){s=\"it's\"}</script>",
        "<script>x='</scripts>';y=1<z</script >",
        "<style>a::after{content:'<b'}</style>",
        "<textarea><p class=</textarea>",
        "<noscript><img alt='</noscript>",
        "<head><title>1<two</title><script>s=\"</head><body>\";i<n</script></head>",
    ],
)
def test_markup_inside_raw_elements_is_none(raw):
    body = f"<article><h1>A</h1><p>{LONG}</p><p>Short one</p></article>"
    pages = [f"<html>{raw}{body}</html>", f"<html>{body}{raw}</html>", f"<html>{raw}{body}{raw}</html>"]
    got = list(map(web.Extractor(web.default_model()).text, pages))
    assert got == ["A\n\n" + LONG.strip() + "\n\nShort one"] * 3


@pytest.mark.parametrize(
    "attribute", ['data-content="Popover text"', "data-content", 'data-content-id="7"', "data-content=''", 'Data-Content="0"']
)
def test_labels_are_read_from_labelled_pages_only(spark, attribute):
    plain = f"<body><article><h1>A</h1><p>{LONG}</p></article></body>"
    rows = [(1, plain.replace("<p>", f"<p {attribute}>")), (2, plain)]
    got = {r["page_id"]: r["text"] for r in web.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert got == {1: "A\n\n" + LONG.strip(), 2: "A\n\n" + LONG.strip()}
    assert [n.label for n in web.parse("<p data-content='1' data-content-id=7><p class=x data-content=0>", True)] == [None, 1, 0]


@pytest.mark.parametrize("n", [1, 30, 1_000])
def test_many_paragraphs_stay_with_what_holds_them(n):
    article = f"<article><h1>A</h1>{'<p>A short line.</p>' * n}</article>"
    got = web.Extractor(web.default_model()).text(
        f"<body><nav><a href='/'>Home</a></nav>{article}<div class='comments'>{'<p>I do not agree.</p>' * n}</div></body>"
    )
    assert got == "\n\n".join(["A", *["A short line."] * n])


def test_pages_on_odd_rows(spark, empty):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<p>unclosed &am", "t"), (4, "<<<>>> </p></div>", None), (5, "x" * 200_000, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {r["page_id"]: r for r in web.extract(pages).collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[1]["n_chars"] == 0 and len(got) == 5
    assert web.extract(pages.limit(0)).count() == 0


# Toxicity.


def test_toxicity_of_held_out_documents(spark):
    found = base.QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = found.join(marks, "doc_id").where("held_out").collect()
    hit = sum(r["toxic"] == 1 == r["predicted"] for r in rows)
    # Some labels of this table are 1 without any toxic word.
    assert hit / sum(r["toxic"] for r in rows) > 0.75 and hit / sum(r["predicted"] for r in rows) > 0.85


def test_toxicity_on_odd_rows(spark, odd, empty):
    marks = spark.createDataFrame([(4, 0), (7, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, marks)
    found = toxicity.score(odd, model)
    assert found.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.collect())
    assert found.count() == odd.count() and toxicity.score(empty, model).count() == 0


# Licences.


def test_phrases_equal_brute_force(spark, documents):
    found = base.QUERIES["op10_licences"](spark, SOME)
    texts = dict(rows_of(spark.read.parquet(f"{SOME}/documents.parquet"), "doc_id", "text"))
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    rows = found.collect()
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in rows} == {k: brute.phrases(t) for k, t in texts.items()}
    for r in rows:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    texts = [("x", " ".join(rng.choices("abc", k=30))) for _ in range(3)]
    auto, _ = licences.automaton(tuple(texts))
    lines = [f" {t} " for _, t in texts]
    words = rng.choices("abcd", k=400)
    held = lambda a, b: any(f" {' '.join(words[a:b])} " in line for line in lines)
    want = set()
    for a in range(400):
        b = a
        while b < 400 and held(a, b + 1):
            b += 1
        if b - a >= licences.MIN_MATCH and not (a and held(a - 1, b)):
            want.add((a, b - a))
    ids = np.array([auto.ids.get(w.encode(), -1) for w in words])
    assert {(s, n) for s, n, _ in auto.matches(ids)} == want
    for start, n, state in auto.matches(ids):
        places = {(k, i + n - 1) for k, (_, t) in enumerate(texts) for i in range(30) if t.split()[i : i + n] == words[start : start + n]}
        assert set(auto.ends[state]) == places


def test_spans_survive_small_changes(odd, empty):
    label, template = licences.TEMPLATES[5]
    words = licences.words("before it " + template.replace("modify", "alter") + " after it")
    found = licences.spans(words, tuple(licences.TEMPLATES))
    assert (label, 2) in {s[:2] for s in found} and licences.spans(words[:12], tuple(licences.TEMPLATES)) == []
    got = licences.scan(odd)
    assert got.count() == odd.count() and licences.scan(empty).count() == 0
    assert rows_of(got.where("doc_id = 1"), "n_words", "n_base", "first_word", "labels", "score") == [(0, 0, None, "", 0.0)]
