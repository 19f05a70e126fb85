"""Repeatable random rows and splits, driven by a hash of the row key."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.order import order_statistics

# 13 hexadecimal digits are 52 bits, which a double still holds exactly.
HASH_DIGITS = 13
DRAWS = 1 << (4 * HASH_DIGITS)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def row_digest(key: str | Sequence[str], seed: int) -> Column:
    """``md5`` of the key columns and the seed, joined by ``|``."""
    parts = [F.col(name).cast("string") for name in _keys(key)]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def row_draw(key: str | Sequence[str], seed: int) -> Column:
    """The leading digits of the digest: text in the order of the numbers it stands for."""
    return F.substring(row_digest(key, seed), 1, HASH_DIGITS)


def _as_text(number: int) -> Column:
    return F.lit(f"{number:0{HASH_DIGITS}x}")


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int = 1, seed: int = 0) -> DataFrame:
    """``n`` random rows: those with the smallest digest, then the smallest key."""
    # As a column, the digest is computed once for each row and not for each comparison.
    drawn = df.withColumn("_digest", row_digest(key, seed))
    return drawn.orderBy("_digest", *_keys(key)).limit(n).drop("_digest")


def split_rows(
    df: DataFrame,
    key: str | Sequence[str],
    fraction: float = 0.75,
    seed: int = 0,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test) by the draw of each row.

    By default a row is a training row when its draw falls below ``fraction`` of
    the range: no shuffle, sizes right on average. With ``exact`` the training
    part has ``floor(fraction * n)`` rows; the draw at that rank is found
    by counting passes, and the split itself is again a plain filter. Keys must
    then be unique.
    """
    draw = row_draw(key, seed)
    if not exact:
        chosen = draw < _as_text(int(fraction * DRAWS)) if fraction < 1 else F.lit(True)
        return df.where(chosen), df.where(~chosen)
    total = df.count()
    size = int(total * fraction)
    if size <= 0:
        return df.where(F.lit(False)), df
    # Draws are uniform, so the one at this rank lies close to its share of the range.
    reach = 6 * math.sqrt(fraction * (1 - fraction) / total) + 1 / total
    guess = (int((fraction - reach) * DRAWS), int((fraction + reach) * DRAWS))
    draws = df.select(F.conv(draw, 16, 10).cast("long").alias("draw"))
    last = _as_text(int(order_statistics(draws, "draw", [size - 1], guess)[size - 1]))
    # Rows that share the last draw are told apart by their key; there are hardly any.
    keys = _keys(key)
    tied = F.col("_draw") == last
    below, ties, tied_keys = df.select(*keys, draw.alias("_draw")).agg(
        F.count_if(F.col("_draw") < last),
        F.count_if(tied),
        F.sort_array(F.collect_set(F.when(tied, F.struct(*keys)))),
    ).first()
    if below + ties == size:
        chosen = draw <= last
    elif len(tied_keys) < ties:
        raise ValueError(f"split key {keys} is not unique")
    else:
        chosen = draw < last
        for found in tied_keys[: size - below]:
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(found[k])) for k in keys])
            chosen = chosen | same
    return df.where(chosen), df.where(~chosen)
