"""Language identification by bit-sliced Bloom filters of character n-grams.

Slot i of the filter is a word with one bit per language. The words of an n-gram's slots, combined by AND, are the set of
languages that contain it; a text's n-grams are counted by language, the counts are corrected for the filter's
known rate of false positives, and the language whose corrected share comes closest to that of its own texts wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.base import fresh, quoted, small, text_of, without

#: Bounds of the training sample: documents of each language, and the length beyond which one isn't drawn.
SAMPLE = 1_500
SAMPLE_CHARS = 100_000
#: N-grams that a task counts at a time.
COUNTED = 8_000_000
SIZES = (2, 3, 4)
#: N-grams kept for each language, the most frequent first.
GRAMS = 20_000
#: A language contains an n-gram whose frequency there is at least this share of the greatest among the languages.
SHARE = 0.2
MIN_COUNT = 3
SLOTS = 1 << 19
HASHES = 3
BLOCK = 1 << 20
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-case letters of a text, each run of anything else as one space."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else text.lower()
    points = np.frombuffer(kept.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if text.isascii():
        points = np.where((points >= 97) & (points <= 122), points, np.uint64(32))
    points = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    space = points == 32
    return points[~(space & np.concatenate([[False], space[:-1]]))]


def grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of each size, in blocks of bounded length."""
    for at in range(0, len(points), BLOCK):
        for size in SIZES:
            part = points[at : at + BLOCK + size - 1]
            n = min(BLOCK, len(part) - size + 1)
            if n <= 0:
                continue
            h = np.full(n, np.uint64(size))
            for k in range(size):
                h = (h ^ part[k : k + n]) * _MIX
                h ^= h >> np.uint64(32)
            yield h


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    words: np.ndarray  # slots x ceil(languages / 64)
    false_rate: np.ndarray
    own_rate: np.ndarray
    usual: int  # the language with most training documents

    def sets(self, h: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that contain it, as bits."""
        mask = np.uint64(SLOTS - 1)
        found = self.words[(h & mask).astype(np.int64)]
        for _ in range(HASHES - 1):
            h = h * _STEP
            h = h ^ (h >> np.uint64(29))
            found = found & self.words[(h & mask).astype(np.int64)]
        return found

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """N-grams of a text by language, and all of them."""
        total = np.zeros(len(self.languages), np.int64)
        n = 0
        for h in grams(letters(text)):
            found = self.sets(h)
            n += len(h)
            for i in range(len(self.languages)):
                total[i] += np.count_nonzero(found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1))
        return total, n

    def shares(self, text: str) -> np.ndarray:
        total, n = self.counts(text)
        return np.clip((total / max(1, n) - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        fit = self.shares(text) / self.own_rate
        if fit.sum() <= 0:
            return self.languages[self.usual], 0.0
        best = int(np.argmax(fit))
        return self.languages[best], float(min(1.0, fit[best] / fit.sum()))


def _filled(slots: list[np.ndarray]) -> np.ndarray:
    words = np.zeros((SLOTS, -(-len(slots) // 64) or 1), np.uint64)
    mask = np.uint64(SLOTS - 1)
    for i, h in enumerate(slots):
        for _ in range(HASHES):
            at = (h & mask).astype(np.int64)
            words[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            h = h * _STEP
            h = h ^ (h >> np.uint64(29))
    return words


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Model:
    """Learn the languages of ``lang_col`` from a bounded sample of each, drawn by a hash of the id.

    Rows without id, text or language are left out. N-grams are counted by Spark; at most ``GRAMS`` of each language come
    to the driver. Without any row the model knows no language.
    """
    key, lang = F.col(quoted(id_col)), F.col(quoted(lang_col))
    usable = docs.where(key.isNotNull() & lang.isNotNull() & F.col(quoted(text_col)).isNotNull())
    usable = usable.select(key.alias("id"), lang.alias("lang"), text_of(text_col).alias("text"))
    usable = usable.where(F.length("text").between(1, SAMPLE_CHARS))
    # The first of each language by hash. What a language's size makes unlikely to be among them is left out before, so
    # that the ranking sees about half as many rows again as the sample, however many the language has.
    drawn = usable.select("id", "lang", F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 31)).alias("draw"))
    sizes = drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    drawn = drawn.join(small(sizes), "lang").where(F.col("draw") / (1 << 31) * F.col("size") <= 1.5 * sample)
    order = Window.partitionBy("lang").orderBy("draw", "id")
    drawn = drawn.select("id", "lang", "draw").distinct()
    drawn = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    drawn = drawn.select("id", F.col("lang").alias("_lang"))
    rows = usable.join(F.broadcast(drawn), "id").where("lang = _lang")
    # Rows that share an id are one document, whatever their number.
    rows = rows.groupBy("id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                found: list[np.ndarray] = []
                for i, text in enumerate(texts):
                    found += grams(letters(text))
                    if found and (i + 1 == len(texts) or sum(map(len, found)) > COUNTED):
                        values, n = np.unique(np.concatenate(found), return_counts=True)
                        yield pd.DataFrame({"lang": name, "gram": values.view(np.int64), "n": n})
                        found = []

    counted = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram")
    counted = counted.agg(F.sum("n").alias("n")).persist()
    try:
        sizes = {r["lang"]: (r["n"], r["g"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("g")).collect()}
        names = tuple(sorted(sizes))
        totals = counted.groupBy("lang").agg(F.sum("n").alias("all"))
        rate = counted.where(F.col("n") >= MIN_COUNT).join(F.broadcast(totals), "lang")
        rate = rate.withColumn("rate", F.col("n") / F.col("all"))
        top = rate.groupBy("gram").agg(F.max("rate").alias("top"))
        typical = rate.join(top, "gram").where(F.col("rate") >= SHARE * F.col("top"))
        ranked = typical.withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("rate"), "gram"))
        )
        kept = ranked.where(F.col("rank") <= GRAMS).select("lang", "gram", "rate").toPandas()
    finally:
        counted.unpersist()
    slots, own = [], []
    for name in names:
        part = kept[kept["lang"] == name]
        slots.append(np.sort(part["gram"].to_numpy(np.int64)).view(np.uint64))
        own.append(max(float(part["rate"].sum()), 1e-6))
    words = _filled(slots)
    fill = np.array([np.count_nonzero(words[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(names))])
    usual = int(np.argmax([sizes[name][0] for name in names])) if names else 0
    return Model(names, words, (fill / SLOTS) ** HASHES, np.array(own), usual)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the winner's part of all languages' shares.

    ``und`` with score 0 where the text is null or has no letter. A text none of whose n-grams is known gets
    the most frequent language with score 0. Columns of these names are replaced.
    """
    docs = without(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most SLOTS words for each 64 languages

    @pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    name = fresh(docs, "_guess")
    guess = docs.withColumn(name, run(F.col(quoted(text_col)).cast("string")))
    return guess.withColumns({"lang_pred": F.col(f"{name}.lang"), "score": F.col(f"{name}.score")}).drop(name)
