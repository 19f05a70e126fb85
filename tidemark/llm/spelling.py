"""Spelling variants: words one edit apart, met through one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Every word sends the whole one-edit neighbourhood of its reduced form, which is small
since few symbols can be put in, to the reduced forms of all words; what meets is compared letter by letter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, text_of
from tidemark.session import cut_lineage

MIN_LETTERS = 6
MIN_COUNT = 5
#: A near word is the form of a word if it occurs this many times as often.
RATIO = 5
#: Occurrences whose hash this number divides lose a letter.
SLIP = 199
#: Reduced forms of the shortest words there are for each word; more symbols make larger neighbourhoods and fewer meetings.
ROOM = 4
#: Distinct words counted in a task before they are passed on, and keys of neighbours made at once.
HELD_WORDS, HELD_KEYS = 300_000, 1 << 20
#: Words whose neighbourhoods one task makes.
TASK_WORDS = 10_000
#: Longer words travel as numbers; their letters are fetched for those that meet.
CARRIED = 64
#: An odd factor; reduced words are compared by polynomials in it, modulo 2^64.
FACTOR = 0x9E3779B97F4A7C15


def words_of(key: str, text: str, least: int = MIN_LETTERS, slip: int | None = SLIP) -> Counter[str]:
    """How often each word of at least ``least`` letters occurs in a text, with slips by the hash of key and word."""
    lower = text.encode().lower().decode()
    found = Counter(re.findall(f"[a-zÀ-ÿ]{{{least},}}", lower))
    if slip is None:
        return found
    start = crc32(f"{key}:".encode())
    kept: Counter[str] = Counter()
    for word, n in found.items():
        mark = crc32(word.encode(), start)
        if mark % slip:
            kept[word] += n
        elif len(word) > least:
            at = mark % len(word)
            kept[word[:at] + word[at + 1 :]] += n
    return kept


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    slip: int | None = SLIP,
) -> DataFrame:
    """(word, n): the words of all texts that occur ``min_count`` times or more; counted in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
                for word, n in words_of(key.as_py(), text.as_py(), least, slip).items():
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield passed_on()
        yield passed_on()

    key = F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))
    counted = docs.select(key.alias("id"), text_of(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def symbols_for(words: int, least: int = MIN_LETTERS) -> int:
    """Symbols enough that the shortest words have ``ROOM`` reduced forms for each word of the vocabulary."""
    symbols = 4
    while symbols**least < ROOM * words:
        symbols += 1
    return symbols


def _reduced(words: list[str], symbols: int) -> np.ndarray:
    """One row of symbols, from 1, for each of these words of equal length."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return (points % symbols + 1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, FACTOR, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def keys_of(words: list[str], symbols: int) -> np.ndarray:
    """The key of the reduced form of each of these words of equal length."""
    forms = _reduced(words, symbols)
    return (forms * _powers(forms.shape[1])[: forms.shape[1]]).sum(axis=1, dtype=np.uint64)


def neighbours(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the word, key) of every reduced form that is equal or one edit away; words of equal length.

    Keys of edits follow from the sums before and after a place, so none is built letter by letter. Long words
    come in blocks of places, and only there a key may come twice.
    """
    forms = _reduced(words, symbols)
    n, length = forms.shape
    powers = _powers(length + 1)
    terms = forms * powers[:length]
    before = np.zeros((n, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    back = np.uint64(pow(FACTOR, -1, 1 << 64))
    kinds = np.arange(1, symbols + 1, dtype=np.uint64)
    step = max(1, HELD_KEYS // (n * 2 * symbols))
    for first in range(0, length + 1, step):
        at = np.arange(first, min(first + step, length))
        spots = np.arange(first, min(first + step, length + 1))
        put = (kinds[None, None, :] * powers[spots][None, :, None]).astype(np.uint64)
        inserted = (before[:, spots] + (whole - before[:, spots]) * np.uint64(FACTOR))[:, :, None] + put
        deleted = before[:, at] + (whole - before[:, at + 1]) * back
        replaced = (whole - terms[:, at])[:, :, None] + kinds[None, None, :] * powers[at][None, :, None]
        keys = np.concatenate([whole, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)], axis=1)
        keys.sort(axis=1)
        fresh = np.ones(keys.shape, bool)
        fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
        yield np.nonzero(fresh)[0], keys[fresh]


def _met(words: DataFrame, symbols: int, whole: bool) -> DataFrame:
    """(key, id, word, n) of the reduced form of each word, or of its whole neighbourhood; long words without letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = np.array(batch.column("word").to_pylist(), object)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                size = max(1, HELD_KEYS // ((2 * int(length) + 1) * symbols)) if whole else len(rows)
                for first in range(0, len(rows), size):
                    some = rows[first : first + size]
                    if whole:
                        found = neighbours(list(texts[some]), symbols)
                    else:
                        found = [(np.arange(len(some)), keys_of(list(texts[some]), symbols))]
                    for places, keys in found:
                        taken = batch.take(pa.array(some[places]))
                        letters = taken.column("word") if length <= CARRIED else pa.nulls(len(places), pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.view(np.int64)), taken.column("id"), letters, taken.column("n")],
                            ["key", "id", "word", "n"],
                        )

    return words.mapInArrow(run, "key long, id long, word string, n long")


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(id, other, other_n, other_word) for every ordered pair of different words one edit apart.

    ``words`` has id, word and n, no word twice. Pairs are compared where they meet, except long words, whose letters
    are joined to the few that met.
    """
    ours = _met(words.repartition(max(1, words.count() // TASK_WORDS)), symbols, whole=True)
    theirs = _met(words, symbols, whole=False).select(
        "key", F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n")
    )
    known = F.col("word").isNotNull() & F.col("other_word").isNotNull()
    one_edit = F.levenshtein("word", "other_word", 1) == 1
    met = ours.join(theirs, "key").where((F.col("id") != F.col("other")) & (~known | one_edit)).drop("key", "n")
    met = cut_lineage(met, "near")
    # Long words only.
    texts = words.select("id", F.col("word").alias("letters"))
    others = texts.toDF("other", "other_letters")
    late = met.where(~known).join(texts, "id").join(others, "other")
    late = late.where(F.levenshtein("letters", "other_letters", 1) == 1)
    columns = ["id", "other", "other_n"]
    late = late.select(*columns, F.col("other_letters").alias("other_word")).distinct()
    return met.where(known).select(*columns, "other_word").unionByName(late)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached from each word along ``forms`` (word, form), by doubling the steps.

    A form occurs several times as often as its word, so there are no circles, and steps grow with the
    logarithm of the greatest count, rounds with the logarithm of that. Each round is written.
    """
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = now.join(far, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        ahead = cut_lineage(ahead, "roots")
        now = ahead.drop("moved")
        if ahead.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    slip: int | None = SLIP,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of at least ``least`` letters and ``min_count`` occurrences.

    Words are runs of Latin letters, A-Z in lower case. ``slip`` takes a letter out of those occurrences whose hash of id and
    word it divides (None: texts as they are). Near words differ by one letter put in, left out or replaced. The form of a
    word is its most frequent near word (the first in code-point order of equal ones) if that occurs ``ratio``
    times as often or more, else null; the root is where the forms lead, the word itself without a form.

    A null text has no words, a null id counts as an empty one, and each row counts, repeated ones too. Other
    columns are not read. An empty table gives no rows.
    """
    counted = count_words(docs, id_col, text_col, least, min_count, slip)
    words = cut_lineage(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = near_words(words, symbols_for(words.count(), least))
    first = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other_word").alias("word")))
    best = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    found = words.join(best, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.word"), -F.col("best.n"))).alias("best"),
    )
    found = found.select("word", "n", "n_near", F.col("best.word").alias("form"), F.col("best.col2").alias("form_n"))
    found = cut_lineage(found, "forms")
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
