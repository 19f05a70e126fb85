"""Toxicity by compression distance: how much better one dictionary compresses a window than another.

Two zstandard dictionaries share a background of ordinary text; one ends with what was trained on words of toxic documents, the
other with what was trained on words of ordinary ones. A window is one word between two marks that both
dictionaries know, so the frame costs the same on either side and the difference in length is what the word itself gains. A
document's score comes from the distribution of these differences by thresholds calibrated on documents that
the calibration dictionaries have not seen.
"""

from __future__ import annotations

import random
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, text_of

#: Bounds of the training sample: documents of either label, the length beyond which one isn't drawn, and bytes of all.
TOXIC_SAMPLE = 2_000
ORDINARY_SAMPLE = 6_000
SAMPLE_CHARS = 100_000
SAMPLE_BYTES = 100 << 20

LEVEL = 9
BACKGROUND_BYTES = 32_768
BACKGROUND_LINES = 100_000
CLASS_BYTES = 8_192
WORD_BYTES = 48
#: A word counts as typical of a label when it stands in so many different contexts there and in none on the other side.
CONTEXTS = 3
TOP = 9
MARK = bytes(range(1, 25))
#: Lower-case ASCII letters, other ASCII characters as spaces, the rest as it is.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Differences remembered by a worker, to save time only.
MEMORY = 100_000


def words(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


def _contexts(texts: Iterable[str]) -> dict[bytes, int]:
    """In how many different pairs of neighbours each word stands."""
    numbers: dict[bytes, int] = {}
    found = []
    for text in texts:
        ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words(text)], np.uint64)
        if len(ids):
            before, after = np.concatenate([[0], ids[:-1]]), np.concatenate([ids[1:], [0]])
            around = (before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ after.astype(np.uint64)
            around *= np.uint64(0xD6E8FEB86659FD93)
            found.append(np.unique(ids << np.uint64(32) | around >> np.uint64(32)))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    counts = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(numbers) + 1)
    return {word: int(counts[i]) for word, i in numbers.items()}


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary of at most ``size`` bytes; the samples themselves where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _samples(counts: dict[bytes, int], seed: int) -> list[bytes]:
    spread = [b" " + word[:WORD_BYTES] + b" " for word, n in sorted(counts.items()) for _ in range(min(n, 50))]
    random.Random(seed).shuffle(spread)
    return [b"".join(spread[i : i + 8]) for i in range(0, len(spread), 8)]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary, equally long."""
    near, far = _contexts(toxic), _contexts(ordinary)
    typical = {w: n for w, n in near.items() if n >= CONTEXTS and w not in far and len(w) >= 3}
    usual = {w: n for w, n in far.items() if n >= CONTEXTS and w not in near and len(w) >= 3}
    # Lines of eight words, about as many of each text as of any other.
    lines, each = [], max(1, BACKGROUND_LINES // max(1, len(ordinary)))
    for text in ordinary:
        w = words(text)
        starts = range(0, len(w), 8 * max(1, -(-len(w) // (8 * each))))
        lines += [b" " + b" ".join(w[i : i + 8]) + b" " for i in starts]
    background = _trained(BACKGROUND_BYTES, lines) + MARK
    first, second = _trained(CLASS_BYTES, _samples(typical, 2)), _trained(CLASS_BYTES, _samples(usual, 3))
    size = max(len(first), len(second))
    return tuple(background + part.rjust(size, b"\0") for part in (first, second))


class Windows:
    """Differences of compressed length, ordinary less toxic, for words."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.sides = [self._compressor(raw) for raw in (ordinary, toxic)]
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _compressor(raw: bytes):
        import zstandard

        data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def gains(self, text: str) -> np.ndarray:
        found = words(text)
        new = [w for w in dict.fromkeys(found) if w not in self.known]
        if len(self.known) + len(new) > MEMORY:
            self.known.clear()
            new = list(dict.fromkeys(found))
        ordinary, toxic = self.sides
        for word in new:
            # A word of any length is covered: long ones are the best of their parts.
            self.known[word] = max(
                len(ordinary.compress(window)) - len(toxic.compress(window))
                for window in (
                    MARK + b" " + word[i : i + WORD_BYTES] + b" " + MARK for i in range(0, len(word), WORD_BYTES)
                )
            )
        return np.fromiter((self.known[w] for w in found), np.int64, len(found))

    def features(self, text: str) -> np.ndarray:
        """Logarithms of how many windows gain 0, 1, ... bytes or more, of all, and the share that gains three."""
        gains = np.clip(self.gains(text), 0, TOP)
        n = max(1, len(gains))
        tail = np.cumsum(np.bincount(gains, minlength=TOP + 1)[::-1])[::-1]
        return np.concatenate([np.log1p(tail), [np.log1p(len(gains)), tail[3] / n]])


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]


def _calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic thresholds by Newton's method, labels weighted to their share among all labelled rows."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - centre) / scale]
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    ridge = np.eye(a.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


def fit(rows: list[tuple[str, int]], prior: float) -> Model:
    """A model from (text, label) rows; ``prior`` is the share of label 1 among all labelled rows.

    Each half is measured with dictionaries of the other half, and the thresholds are fitted to both; the dictionaries
    that score later come from all rows. Without rows of both labels every score is ``prior``.
    """
    toxic = [t for t, y in rows if y == 1]
    ordinary = [t for t, y in rows if y == 0]
    if len(toxic) < 2 or len(ordinary) < 2:
        size = len(Windows(MARK, MARK).features(""))
        bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
        return Model(MARK, MARK, (bias, *[0.0] * size), (0.0,) * size, (1.0,) * size)
    x, y = [], []
    for half in (0, 1):
        windows = Windows(*dictionaries(toxic[half::2], ordinary[half::2]))
        for label, texts in ((1, toxic), (0, ordinary)):
            for text in texts[1 - half :: 2]:
                x.append(windows.features(text))
                y.append(label)
    w, centre, scale = _calibrate(np.array(x), np.array(y), prior)
    return Model(*dictionaries(toxic, ordinary), tuple(w), tuple(centre), tuple(scale))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    toxic_sample: int = TOXIC_SAMPLE,
    ordinary_sample: int = ORDINARY_SAMPLE,
) -> Model:
    """Fit on a bounded sample of labelled documents, drawn by a hash of the id.

    ``labels`` has at most one row per id that counts (the greatest label); rows without id or label are left out.
    """
    key = F.col(quoted(id_col))
    marks = (
        labels.where(key.isNotNull() & F.col(quoted(label_col)).isin(0, 1))
        .groupBy(key.alias("_id"))
        .agg(F.max(F.col(quoted(label_col))).cast("int").alias("_y"))
    )
    share = marks.agg(F.avg("_y")).first()[0]
    draw = F.xxhash64("_id", F.lit("sample"))
    wanted = marks.where("_y = 1").orderBy(draw).limit(toxic_sample).unionByName(
        marks.where("_y = 0").orderBy(draw).limit(ordinary_sample)
    )
    texts = docs.select(key.alias("_doc"), text_of(text_col).alias("_text")).where(
        F.length("_text") <= SAMPLE_CHARS
    )
    # One text for each id, however many rows share it; of the drawn ones so many as the bound of bytes allows.
    one = texts.join(F.broadcast(wanted), F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        F.min("_text").alias("_text"), F.min("_y").alias("_y")
    )
    so_far = Window.orderBy(draw).rowsBetween(Window.unboundedPreceding, 0)
    sizes = one.select("_id", F.octet_length("_text").cast("long").alias("_size"))
    some = sizes.withColumn("_sum", F.sum("_size").over(so_far)).where(F.col("_sum") <= SAMPLE_BYTES).select("_id")
    rows = one.join(F.broadcast(some), "_id").select("_id", "_text", "_y").collect()
    rows.sort(key=lambda r: r["_id"])
    return fit([(r["_text"], r["_y"]) for r in rows], float(share or 0.0))


@lru_cache(maxsize=1)
def _windows(toxic: bytes, ordinary: bytes) -> Windows:
    return Windows(toxic, ordinary)


def score_text(model: Model, text: str) -> float:
    x = (_windows(model.toxic, model.ordinary).features(text) - np.array(model.centre)) / np.array(model.scale)
    z = model.weights[0] + x @ np.array(model.weights[1:])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score_column(model: Model, text: Column) -> Column:
    # One text at a time is taken out of the batch, so a worker holds no second copy of it.
    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array((score_text(model, t.as_py()) for t in texts), pa.float64())

    return run(text)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Whole texts are scored; a null or empty text has no windows and gets the score of none. Columns of these names are
    replaced. Equal texts get equal scores.
    """
    from tidemark.llm.base import without

    scored = without(docs, "score", "predicted").withColumn("score", score_column(model, text_of(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`score` does not predict as toxic, with the columns they had."""
    return docs.where(score_column(model, text_of(text_col)) < 0.5)
