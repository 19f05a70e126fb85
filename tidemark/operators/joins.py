"""Joins of a large table to a smaller one.

A side is broadcast only after its size was checked. Beyond that size both sides are shuffled once; the hot
keys of the large side, whose number has a proven bound, are spread over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tidemark.functions.scalar import fill_from
from tidemark.session import cut_lineage

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
HOT_SHARE = 0.001
SALTS = 32


def _row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row: text by its length, plain values as 16 bytes."""
    parts = [F.lit(16 * len(df.columns))]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
    return reduce(lambda a, b: a + b, parts)


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether all of ``df`` is small enough to send to every executor.

    One aggregate that combines inside the tasks; a single row comes back.
    """
    rows, size = df.agg(F.count("*"), F.sum(_row_bytes(df).cast("long"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_key_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows.

    Fewer than ``1 / share`` keys can, so the list is bounded. A frequent-items
    sketch finds them in one aggregate over the key columns; keys are not
    shuffled. Which keys count as hot only decides the way they are joined.
    """
    most = math.ceil(1 / share)
    top = F.expr(f"approx_top_k(h, {most}, {10 * most})")
    hashes = df.dropna("any", subset=list(keys)).select(_key_hash(keys).alias("h"))
    total, items = hashes.agg(F.count("*"), top).first()
    return [item["item"] for item in items or [] if item["count"] > total * share]


def _salted_join(fact: DataFrame, dim: DataFrame, keys: list[str], how: str, hot: list[int]) -> DataFrame:
    """One shuffle join that spreads the hot keys of ``fact`` over several tasks.

    Only the rows of ``dim`` with a hot key are copied, once for each salt.
    """
    is_hot = fill_from(_key_hash(keys).isin(hot), F.lit(False))
    salt = F.when(is_hot, F.pmod(F.xxhash64(F.struct("*")), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return (
        fact.withColumn("_salt", salt)
        .join(dim.withColumn("_salt", F.explode(copies)), keys + ["_salt"], how)
        .drop("_salt")
    )


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    split_hot: bool = True,
    hot: Sequence[int] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Equi-join ``fact`` to ``dim``; the key columns appear once in the result.

    ``how`` is one of inner, left, left_semi, left_anti: every row of ``fact``
    may be handled apart from the others, which the split by hot key relies on.
    Without ``split_hot`` a large ``dim`` means one plain shuffle, for a ``fact``
    that is already summed by key. ``hot`` are key hashes from :func:`hot_key_hashes`; without them
    a batch looks for its own, in one pass over the key columns. A caller that joins one ``dim`` several times may ask
    :func:`fits_broadcast` once and pass the answer as ``small``.

    A stream gets no hint: every micro-batch is planned anew, and Spark broadcasts ``dim`` as long as its files
    are small enough by then. Keys that are known to be hot, say from landed messages, are split there, too.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fact.isStreaming:
        return _salted_join(fact, dim, keys, how, list(hot)) if hot else fact.join(dim, keys, how)
    if fits_broadcast(dim, max_rows) if small is None else small:
        return fact.join(F.broadcast(dim), keys, how)
    if not split_hot:
        return fact.join(dim, keys, how)
    for key in keys:
        left, right = fact.schema[key].dataType, dim.schema[key].dataType
        if left != right:
            raise ValueError(f"key {key} is {left.simpleString()} here and {right.simpleString()} there")
    found = list(hot) if hot is not None else hot_key_hashes(fact, keys)
    return _salted_join(fact, dim, keys, how, found) if found else fact.join(dim, keys, how)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str = "id",
    how: str = "inner",
    require_unique: bool = False,
    max_rows: int = MAX_BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Add the columns of a static dimension to messages, batch or streaming.

    With the default inner join a message without metadata is dropped. A key
    that occurs twice in ``dim`` doubles its messages; ``require_unique``
    raises instead.
    """
    if require_unique:
        twice = dim.groupBy(key).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"dimension key {key}={twice[0][key]!r} occurs {twice[0]['count']} times")
    return join_dimension(df, dim, key, how, max_rows, small=small)


def over_quota(
    usage: DataFrame,
    dim: DataFrame,
    key: str = "id",
    value: str = "value",
    quota: str = "quota",
    email: str = "email",
    ts: str = "timestamp",
    small: bool | None = None,
) -> DataFrame:
    """``(email, usage, quota, timestamp)`` of every usage row above its user's quota.

    ``usage`` has one row for each user and window. Each window is compared to the
    quota by itself, inside the equi-join as a residual condition.
    """
    joined = join_dimension(
        usage.select(key, F.col(value).alias("usage"), F.col(ts).alias("timestamp")),
        dim.select(key, F.col(email).alias("email"), F.col(quota).alias("quota")),
        key,
        split_hot=False,
        small=small,
    )
    return joined.where(F.col("usage") > F.col("quota")).select("email", "usage", "quota", "timestamp")


def drop_groups_without(df: DataFrame, group: str, column: str) -> DataFrame:
    """Drop the rows of every group in which ``column`` is never known.

    The list of such groups is cut from its lineage, so that checking its size
    does not scan ``df`` once more.
    """
    empty = df.groupBy(group).agg(F.count(column).alias("known")).where("known < 1").select(group)
    return join_dimension(df, cut_lineage(empty), group, "left_anti")


def merge_inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of a row table ``left`` to a lookup ``right``, key column first."""
    return join_dimension(left, right, key)
