"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions only.

Pass one counts two slots of every text's hash and keeps a bit for each slot that was met
more than once. Pass two looks both slots up: a row that misses either bit is alone for certain and
goes straight to the result; only the others are shuffled, grouped and compared by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, sheltered, text_of, without
from tidemark.session import cut_lineage

#: Runs of white space other than one plain space; replacing them leaves single spaces as they are.
UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
BITS_PER_ROW = 16
#: Upper bound of the filter that is broadcast: 32 MB of bits. Beyond ``MAX_BITS / BITS_PER_ROW`` rows it
#: fills up, and more rows that are alone take the way of the repeated ones; the result stays the same.
MAX_BITS = 1 << 28
_BLOCK = 12  # 4096 slots, 64 words of 64 bits, in one row of the filter

RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_of(text_col), UNEVEN_SPACE, " ")


def _slots(text: Column, bits: int) -> list[Column]:
    h = F.xxhash64(text)
    mask = F.lit(bits - 1).cast("long")
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def repeated_slots(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """The filter: (block, words), a bit for each slot that two or more rows share."""
    slots = F.array_distinct(F.array(*_slots(normalised(text_col), bits)))
    counted = docs.select(F.explode(slots).alias("slot")).groupBy("slot").count().where("count > 1")
    bit = F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")
    words = counted.groupBy(F.expr("slot >> 6").alias("word")).agg(bit)
    packed = words.groupBy(F.expr(f"word >> {_BLOCK - 6}").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.expr("int(word & 63)"), "bits"))).alias("m")
    )
    return packed.select("block", F.expr("transform(sequence(0, 63), i -> coalesce(m[i], 0L))").alias("words"))


def _flagged(docs: DataFrame, text_col: str, bits: int, seen: DataFrame) -> DataFrame:
    """``docs`` with their digest and ``_maybe``: whether the text may occur twice."""
    out = docs.withColumn("_norm", normalised(text_col))
    first, second = _slots(F.col("_norm"), bits)
    out = out.withColumns(
        {"text_sha256": F.sha2("_norm", 256), "_slot0": first, "_slot1": second}
    ).drop("_norm")
    hits = []
    for i in (0, 1):
        part = seen.select(F.col("block").alias(f"_block{i}"), F.col("words").alias(f"_words{i}"))
        out = out.withColumn(f"_block{i}", F.expr(f"_slot{i} >> {_BLOCK}"))
        out = out.join(F.broadcast(part), f"_block{i}", "left")
        word = F.expr(f"_words{i}[int((_slot{i} >> 6) & 63)]")
        hits.append(F.coalesce(F.getbit(word, F.expr(f"int(_slot{i} & 63)")), F.lit(0)) == 1)
    out = out.withColumn("_maybe", hits[0] & hits[1])
    return out.drop(*[f"{c}{i}" for c in ("_slot", "_block", "_words") for i in (0, 1)])


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after each run of white space became one space; a null text
    is an empty one. Of equal texts the row with the smallest id stays; rows without an id come last,
    and of rows that share id and text exactly one stays. Columns of ``docs`` with names of the
    result are replaced. An empty table gives an empty result.

    Groups are counted before the shuffle, so a group of any size sends one row per task; bringing the result
    back to its rows is a plain equi-join of two tables, which adaptive execution splits where a group is hot.
    """
    docs = without(docs, *RESULT)
    # Under plain numbered names, which clash with none that the passes add.
    plain = {name: f"column_{i}" for i, name in enumerate(docs.columns)}
    found = _deduped(docs.toDF(*plain.values()), plain[id_col], plain[text_col], max_bits)
    return found.select(*[F.col(new).alias(old) for old, new in plain.items()], *RESULT)


def _deduped(docs: DataFrame, id_col: str, text_col: str, max_bits: int) -> DataFrame:
    bits = 1 << 16
    rows = docs.count()
    while bits < min(max_bits, rows * BITS_PER_ROW):
        bits *= 2
    seen = cut_lineage(repeated_slots(docs, text_col, bits), "seen")
    flagged = _flagged(docs, text_col, bits, seen)
    key = F.col(quoted(id_col))
    alone = flagged.where(~F.col("_maybe")).select(
        *[quoted(c) for c in docs.columns],
        key.alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # Written once, so that the number that breaks ties is the same wherever it is read.
    maybe = flagged.where("_maybe").drop("_maybe").withColumn("_tie", F.monotonically_increasing_id())
    maybe = cut_lineage(maybe, "maybe")
    order = F.struct(key.isNull().alias("without"), key.alias("id"), F.col("_tie").alias("tie"))
    groups = maybe.groupBy("text_sha256").agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("group_size")
    )
    groups = cut_lineage(groups, "groups")
    grouped = maybe.join(groups, "text_sha256").select(
        *[quoted(c) for c in docs.columns],
        F.col("_first.id").alias("keep_id"),
        "group_size",
        (F.col("_tie") == F.col("_first.tie")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with the columns they had."""
    return sheltered(docs, [id_col, text_col], lambda rows, key, text: exact_dedup(rows, key, text).where("kept"))
