"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question asked again with other values keeps its template.
A capitalised word that starts a sentence is read as a literal and as a name. Windows of five template tokens are joined
by hash; the values that fill the slots of joined windows must map one to one throughout an occurrence, and the share
of a question's windows that a document holds in this way decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import numbered, quoted, sheltered, small, text_of
from tidemark.session import cut_lineage

WINDOW = 5
#: Share of an item's windows that a document must hold.
MIN_COVERAGE = 0.5
#: Windows with fewer literal tokens say nothing by their template and are met by the values in their slots.
MIN_LITERALS = 2
#: Added to the width in hashes of windows met by value.
_BY_VALUE = 1 << 32
#: Hashes of item windows sent to the tasks in one pass; larger benchmarks take several passes.
PASS_HASHES = 2_000_000
#: Tokens of short texts that are read together.
TOGETHER = 1 << 16
OCCURRENCE = ["id", "item", "place"]

# Units that follow a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
    "ms s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "ml cl l liter liters litre litres gallon gallons cup cups percent degree degrees mph kmh kb mb gb tb hz khz mhz ghz "
    "v w kw mw j kj cal kcal n pa kpa usd eur gbp dollar dollars euro euros cent cents".split()
)

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]")
END, NUMBER, UNIT, NAME, LITERAL = range(5)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Of each token a 61-bit hash of its lower-case form above three bits for its kind."""

    def __missing__(self, token: str) -> int:
        from xxhash import xxh64_intdigest

        if token in ".!?\n":
            kind = END
        elif token[0].isdecimal():
            kind = NUMBER
        elif token.lower() in UNITS:
            kind = UNIT
        elif len(token) > 1 and token[0].isupper() and token[1:].islower():
            kind = NAME
        else:
            kind = LITERAL
        if len(self) > 250_000:
            self.clear()
        code = self[token] = (xxh64_intdigest(token.lower().encode(), 0) & ~7 | kind) & (1 << 64) - 1
        return code


_CODES = _Codes()


class Template(NamedTuple):
    """The template tokens of some texts, one text after the other; all arrays have an entry for each of them."""

    words: np.ndarray  #: place among the tokens
    owner: np.ndarray  #: number of the text
    codes: np.ndarray
    slot: np.ndarray
    unsure: np.ndarray  #: whether a literal may be a name as well
    values: np.ndarray  #: codes of the values themselves


def template(tokens: list[str], sizes: list[int]) -> Template:
    """The template of texts whose tokens, ``sizes`` of each, stand one after the other.

    A capitalised word is a name; one that starts a sentence is a literal that may be a name. A unit is one behind a number.
    """
    codes = np.fromiter(map(_CODES.__getitem__, tokens), np.uint64, len(tokens))
    kinds = (codes & np.uint64(7)).astype(np.int8)
    ends = np.cumsum(sizes)
    before = np.concatenate([[END], kinds])[:-1]
    starts = ends[:-1]
    before[starts[starts < len(kinds)]] = END
    slot = (kinds == NUMBER) | (kinds == NAME) & (before != END) | (kinds == UNIT) & (before == NUMBER)
    unsure = (kinds == NAME) & (before == END)
    values = codes >> np.uint64(3) << np.uint64(3)
    codes = np.where(slot, kinds.astype(np.uint64) + np.uint64(1), values)
    real = np.flatnonzero(kinds != END)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return Template(real, owner[real], codes[real], slot[real], unsure[real], values[real])


def _hashed(columns: Iterator[np.ndarray], seed: int, n: int) -> np.ndarray:
    hashes = np.full(n, np.uint64(seed))
    for codes in columns:
        hashes = (hashes ^ codes) * _STEP
        hashes ^= hashes >> np.uint64(29)
    return hashes


def windows(t: Template, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The windows of ``width`` template tokens under every reading: (names, places, hashes, whether by template).

    The bits of ``names`` tell which unsure words of a window are read as names, the others are literals. With too few
    literals the hash is one of the values instead, whatever the reading.
    """
    n = len(t.codes) - width + 1
    if n <= 0 or width <= 0:
        return
    inside = t.owner[:n] == t.owner[width - 1 :]
    pattern = np.zeros(n, np.int64)
    for k in range(width):
        pattern |= t.unsure[k : k + n].astype(np.int64) << k
    readings = {0}
    for unsure in np.unique(pattern[inside]).tolist():
        names = unsure
        while names:
            readings.add(names)
            names = names - 1 & unsure
    for names in sorted(readings):
        places = np.flatnonzero(inside & (pattern & names == names))
        literals = sum(~t.slot[places + k] for k in range(width) if not names >> k & 1) + np.zeros(len(places), np.int16)
        good = literals >= min(MIN_LITERALS, width)
        codes = (np.uint64(NAME + 1) if names >> k & 1 else t.codes[places + k] for k in range(width))
        hashes = _hashed(codes, width, len(places))
        poor = places[~good]
        if len(poor):
            hashes[~good] = _hashed((t.values[poor + k] for k in range(width)), width + _BY_VALUE, len(poor))
        yield names, places, hashes, good


def _found(width: int, wanted: np.ndarray | None, every: bool):
    """Windows of (id, text) rows: all of them, or those whose hash is wanted."""

    # The first bits of the wanted hashes tell nearly all others apart without a search.
    bits = np.zeros(1 << 20, bool)
    if wanted is not None:
        bits[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def rows_of(tokens: list[str], sizes: list[int], first: int) -> list[tuple]:
        """(row, hash, place in the text, width, slots, by template) for texts of the rows from ``first`` on."""
        t = template(tokens, sizes)
        own = min(width, len(t.codes)) if every else width
        starts = np.searchsorted(t.owner, np.arange(len(sizes)))
        rows = []
        for names, places, hashes, good in windows(t, own):
            if wanted is not None and len(places):
                near = np.flatnonzero(bits[(hashes >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(wanted, hashes[near]), len(wanted) - 1)
                near = near[wanted[at] == hashes[near]]
                places, hashes, good = places[near], hashes[near], good[near]
            owners = t.owner[places]
            columns = (places, hashes.view(np.int64), owners, places - starts[owners], good)
            for p, h, i, at, free in zip(*(c.tolist() for c in columns), strict=True):
                # By value all tokens are the same on both sides.
                values = [
                    tokens[t.words[p + k]].lower() for k in range(own) if not free or t.slot[p + k] or names >> k & 1
                ]
                rows.append((first + i, h, at, own, values, free))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            rows: list[tuple] = []
            tokens: list[str] = []
            sizes: list[int] = []
            for i in range(batch.num_rows):
                found = TOKEN.findall(texts[i].as_py())
                tokens += found
                sizes.append(len(found))
                # Short texts are read together; an item has a width of its own.
                if every or len(tokens) >= TOGETHER or i + 1 == batch.num_rows:
                    rows += rows_of(tokens, sizes, i + 1 - len(sizes))
                    tokens, sizes = [], []
            if rows:
                at, cut, pos, size, values, free = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(at)),
                        pa.array(cut, pa.int64()),
                        pa.array(pos, pa.int64()),
                        pa.array(size, pa.int32()),
                        pa.array(values, pa.list_(pa.string())),
                        pa.array(free, pa.bool_()),
                    ],
                    ["id", "hash", "pos", "width", "slots", "free"],
                )

    return run


def _windows_of(df: DataFrame, id_col: str, text_col: str, width: int, wanted=None, every=False) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        _found(width, wanted, every), f"id {kind}, hash long, pos long, width int, slots array<string>, free boolean"
    )


def _places(shift: Column, windows: Column) -> Column:
    """The places a matched window is counted at: its alignment, two blocks of alignments, and the whole document.

    Blocks are as wide as the item and overlap by half, so an occurrence with words put in or left out is in one block, while
    two occurrences in a row are not. The document as one place holds what stands in distant parts.
    """
    half = F.floor(shift * 2 / windows)
    return F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at")),
        F.struct(F.lit(1).alias("kind"), shift.cast("long").alias("at")),
        F.struct(F.lit(2).alias("kind"), F.floor(half / 2).alias("at")),
        F.struct(F.lit(3).alias("kind"), F.floor((half + 1) / 2).alias("at")),
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """Pairs (id, item) of documents that hold an item's template, with what was matched.

    ``windows`` counts an item's windows, ``matched`` those that the document holds with consistent slots, ``coverage``
    is their ratio, at least ``min_coverage``; ``changed`` counts slot values that differ. Slots are consistent where
    an item's value always meets the same value in one occurrence; windows that deviate from its most frequent partner don't
    count. A document may hold several variants of an item: each occurrence is judged on its own, the best one is reported.
    Windows with fewer than two literals are met by the values in their slots. A question with other values can't hold these, so
    the share of the other windows counts where it is greater; ``windows`` and ``matched`` are then of those. An item
    with fewer tokens than ``width`` is one window. Null and empty texts match nothing, nor do rows without an id; rows
    that share an id are taken together.

    Documents are scanned once for each pass over the benchmark; only windows whose hash an item has leave the scan. A window that
    many items share brings no pairs of its own: a document must hold so many of an item's windows that one of the rarest is
    among them, so only those propose the item; what is proposed is then counted over all windows, see :func:`_rarest`.
    """

    known = benchmark.where(F.col(quoted(item_col)).isNotNull())
    items = _windows_of(known, item_col, item_text_col, width, every=True).select(
        F.col("id").alias("item"), "hash", F.col("pos").alias("ipos"), "width", F.col("slots").alias("islots"), "free"
    )
    items = cut_lineage(items.distinct(), "items")
    # Of each window whether it has a template under some reading; a question with other values can hold those only.
    each = items.groupBy("item", "ipos").agg(F.bool_or("free").alias("free"))
    totals = each.groupBy("item").agg(F.count(F.lit(1)).alias("windows"), F.count_if("free").alias("frees"))
    present = docs.where(F.col(quoted(id_col)).isNotNull())
    met = None
    for own in sorted(r[0] for r in items.select("width").distinct().collect()):
        hashes = items.where(F.col("width") == own).select("hash").distinct()
        passes = -(-hashes.count() // PASS_HASHES)
        for k in range(passes):
            part = hashes.where(F.pmod(F.xxhash64("hash"), F.lit(passes)) == k).collect()
            wanted = np.sort(np.array([r[0] for r in part], np.int64).view(np.uint64))
            found = _windows_of(present, id_col, text_col, own, wanted)
            met = found if met is None else met.unionByName(found)
    if met is None:
        met = _windows_of(present.limit(0), id_col, text_col, width)
    met = cut_lineage(met, "met").select("id", "hash", "pos", "slots")
    rare = small(cut_lineage(_rarest(items, each, totals, min_coverage), "rare"))
    proposed = met.select("id", "hash").distinct().join(rare, "hash").select("id", "item").distinct()
    asked = proposed.join(small(items.drop("width")), "item")
    # A window is matched under one reading or several.
    joined = (
        met.join(asked, ["id", "hash"])
        .withColumn("pairs", F.arrays_zip(F.col("islots").alias("i"), F.col("slots").alias("d")))
        .groupBy("id", "item", "pos", "ipos")
        .agg(F.collect_set("pairs").alias("readings"))
        .join(small(each), ["item", "ipos"])
        .join(small(totals), "item")
        .withColumn("place", F.explode(_places(F.col("pos") - F.col("ipos"), F.col("windows"))))
    )
    # Each value of an item and its most frequent partner in an occurrence.
    votes = (
        joined.select(*OCCURRENCE, F.explode(F.array_distinct(F.flatten("readings"))).alias("p"))
        .groupBy(*OCCURRENCE, F.col("p.i").alias("value"), F.col("p.d").alias("partner"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    chosen = votes.groupBy(*OCCURRENCE, "value").agg(F.max_by("partner", F.struct("n", "partner")).alias("partner"))
    meaning = chosen.groupBy(*OCCURRENCE).agg(
        F.map_from_entries(F.collect_list(F.struct("value", "partner"))).alias("meaning"),
        F.count_if(F.col("value") != F.col("partner")).alias("changed"),
    )
    agreed = joined.join(meaning, OCCURRENCE, "left").where(F.expr("exists(readings, r -> forall(r, p -> meaning[p.i] = p.d))"))
    held = (
        agreed.groupBy(*OCCURRENCE)
        .agg(
            F.first("windows").alias("windows"),
            F.first("frees").alias("frees"),
            F.countDistinct("ipos").alias("matched"),
            F.countDistinct(F.when(F.col("free"), F.col("ipos"))).alias("freely"),
            F.max(F.coalesce("changed", F.lit(0))).alias("changed"),
        )
        .withColumn("by_template", F.coalesce(F.expr("freely / nullif(frees, 0) > matched / windows"), F.lit(False)))
        .withColumn("windows", F.when(F.col("by_template"), F.col("frees")).otherwise(F.col("windows")))
        .withColumn("matched", F.when(F.col("by_template"), F.col("freely")).otherwise(F.col("matched")))
        .withColumn("coverage", F.col("matched") / F.col("windows"))
        .where(F.col("coverage") >= min_coverage)
    )
    order = F.struct("coverage", (-F.col("changed")).alias("same"))
    best = held.groupBy("id", "item").agg(
        F.max_by(F.struct("windows", "matched", "coverage", "changed"), order).alias("best")
    )
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.*")


def _rarest(items: DataFrame, each: DataFrame, totals: DataFrame, min_coverage: float) -> DataFrame:
    """(hash, item): the windows by which an item is proposed.

    Of an item's n windows a document must hold m = ceil(``min_coverage`` * n), so of any n - m + 1 windows it holds one; those whose
    hashes the fewest items have are taken, the same among the windows that hold a template, of which a share may count instead.
    """
    shared = items.groupBy("hash").agg(F.countDistinct("item").alias("shared"))
    hashes = items.select("hash", "item", "ipos").distinct()
    worst = hashes.join(shared, "hash").groupBy("item", "ipos").agg(F.max("shared").alias("shared"))
    order = Window.partitionBy("item").orderBy("shared", "ipos")
    free = Window.partitionBy("item", "free").orderBy("shared", "ipos")
    need = lambda n: F.col(n) - F.ceil(F.col(n) * min_coverage - 1e-9) + 1
    ranked = worst.join(each, ["item", "ipos"]).withColumns({"rank": F.row_number().over(order), "free_rank": F.row_number().over(free)})
    taken = ranked.join(totals, "item").where(
        (F.col("rank") <= need("windows")) | (F.col("free") & (F.col("free_rank") <= need("frees")))
    )
    return hashes.join(taken.select("item", "ipos"), ["item", "ipos"]).select("hash", "item").distinct()


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", stored: bool = False) -> DataFrame:
    """``docs`` without the rows that hold an item.

    Each row is judged by its own text, under a number, see :func:`~tidemark.llm.base.numbered` for it and ``stored``: rows without an id are dropped, too, and of rows
    that share an id only those that hold an item.
    """

    def keep(rows: DataFrame, text_name: str) -> DataFrame:
        marked = numbered(rows, "_row", stored)
        leaked = matches(marked, benchmark, "_row", text_name).select(F.col("_row").alias("_leak")).distinct()
        leaked = small(cut_lineage(leaked, "leaked"))
        return marked.join(leaked, F.col("_row") == F.col("_leak"), "left_anti")

    return sheltered(docs, [text_col], keep)
