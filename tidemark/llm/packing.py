"""Packing by powers of two: no sequence crosses documents and none needs padding.

A document of n tokens becomes whole sequences of the greatest length and one piece for each bit of the rest.
Pieces of equal length form a bucket; a training batch draws from one bucket.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, text_of

MAX_TOKENS = 2048
END_ID = 1
#: Longer texts are handed to the tokenizer in parts cut where a token must end.
PART_CHARS = 1 << 18


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """A byte-level tokenizer from a file of ranks; strings of special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that tokenize as the whole does.

    A token takes at most one space, and only in front; so a single space between two characters that are none
    always starts one. A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and not (at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def lengths(n: int, longest: int = MAX_TOKENS) -> list[int]:
    """The lengths into which ``n`` tokens are cut, the longest first."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = MAX_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece: the document, where the piece lies in it, and the sequence it fills.

    ``ids`` holds the tokens as little-endian unsigned 32-bit numbers. ``bucket`` is the length, a power of two up to
    ``longest``; write with ``partitionBy("bucket")`` to have a folder for each. A piece fills its sequence, so
    ``offset`` is 0. ``end_id`` closes every document; a null or empty text is that one token. Rows that repeat
    an id are packed each on its own, rows without an id too. An empty table gives no rows.

    Sequences are numbered by task and row: no shuffle is needed, and a task that runs again gives the same numbers.
    """
    if longest & (longest - 1):
        raise ValueError("the greatest length must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(ranks_path, pattern)
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            rows: list[tuple] = []
            held = 0
            for i in range(batch.num_rows):
                ids: list[int] = []
                for part in parts(texts[i].as_py()):
                    ids += tokens.encode_ordinary(part)
                ids.append(end_id)
                flat = np.array(ids, "<u4")
                start = 0
                for length in lengths(len(flat), longest):
                    rows.append((i, start, length, len(flat), flat[start : start + length].tobytes()))
                    start += length
                held += len(flat)
                if held > 1 << 21 or i + 1 == batch.num_rows:
                    at, *columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(at))]
                        + [pa.array(c, pa.int64()) for c in columns[:3]]
                        + [pa.array(columns[3], pa.binary())],
                        ["id", "start", "length", "doc_tokens", "ids"],
                    )
                    rows, held = [], 0

    pieces = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        cut, f"id {kind}, start long, length long, doc_tokens long, ids binary"
    )
    return pieces.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "doc_tokens",
        F.col("length").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )
