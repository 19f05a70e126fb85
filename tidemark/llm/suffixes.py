"""Exact substring removal by blockwise suffix sorting with a difference cover.

Every stretch of ``LENGTH`` bytes is a suffix cut at that depth. Suffixes are dealt into buckets by their smallest hash of
``GRAM`` bytes, which equal stretches share at the same place; a maximal run of suffixes with one such anchor is one context
and travels as one row. Equal contexts are settled by their hash, and a bucket with a single context holds no other
repeat. The suffixes of the remaining buckets are sorted block by block: the first bytes directly, ties by the ranks
of precomputed blocks at the positions of a difference cover, so a task holds one bucket's bytes and a few numbers for each
suffix. Buckets with very many contexts are settled by a hash of every suffix instead, grouped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, small, text_of
from tidemark.session import cut_lineage

LENGTH = 100
GRAM = 24
#: Bytes of a text handled at a time, and contexts gathered before repeats among them are settled.
BLOCK = 1 << 20
CHUNK = 1 << 18
#: Contexts of one bucket up to which it is sorted in a task.
BUCKET = 4_096
#: Bytes of buckets sorted together.
SORT_BYTES = 1 << 21
#: A difference cover of period 32: every residue is a difference of two of these.
PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 19)
NO_ID = np.int64(2**63 - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def anchors(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts of a text: hash of the anchor, first and last suffix, and the anchor's place; in blocks."""
    windows = LENGTH - GRAM + 1
    for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        part = np.frombuffer(data, np.uint8, min(BLOCK + LENGTH - 1, len(data) - at), at)
        h = (part.astype(np.uint64) + np.uint64(1)) * _BASE
        size = 1
        sums = {1: h}
        while size * 2 <= GRAM:
            h = h[: len(h) - size] * (_BASE ** np.uint64(size)) + h[size:]
            size *= 2
            sums[size] = h
        rest = GRAM - size
        while rest:
            step = 1 << (rest.bit_length() - 1)
            n = len(part) - size - step + 1
            h = h[:n] * (_BASE ** np.uint64(step)) + sums[step][size : size + n]
            size, rest = size + step, rest - step
        h = (h ^ (h >> np.uint64(31))) * _MIX
        h ^= h >> np.uint64(29)
        # The smallest hash of each stretch, the leftmost of equal ones: its place is in the low bits.
        low = np.uint64((1 << 21) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= windows:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        over = windows - size
        if over:
            least = np.minimum(least[: len(least) - over], least[over:])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        yield h[place[first]].view(np.int64), first + at, last + at, place[first] + at


def _mark(data: bytes) -> int:
    """32 bits that tell texts under one id apart."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(data) >> 33


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the unions of overlapping or touching intervals, given in order of document and start."""
    if not len(doc):
        return doc, start, end
    # Ends are lifted by document, so that a running maximum never crosses into the next one.
    lift = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) << 40
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], start[1:] + lift[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(end, at)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of equal contexts in each chunk, and the stretches of the others as removed."""
    from xxhash import xxh3_64_intdigest

    parts: list[tuple[np.ndarray, ...]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        anchor, context, key, place, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place, key, context, anchor))
        anchor, context, key, place, n = (c[order] for c in (anchor, context, key, place, n))
        again = np.concatenate(
            [[False], (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])]
        )
        # A row that repeats the first of its context in document and place is that very stretch.
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
        own = again & (key == key[head]) & (place == place[head])
        keep, again = ~again, again & ~own
        # Repeats leave the search here; neighbouring ones of a document become one row.
        order = np.lexsort((place[again], key[again]))
        k, p, size = (c[again][order] for c in (key, place, n))
        doc = np.cumsum(np.concatenate([[0], (k[1:] != k[:-1]) | (p[1:] >> 32 != p[:-1] >> 32)])) if len(k) else k
        start, end = p & 0xFFFFFFFF, (p & 0xFFFFFFFF) + size + LENGTH - 1
        at, start, end = _merged(doc, start, end)
        first = np.searchsorted(doc, at) if len(doc) else at
        gone_key, gone_place = k[first], (p[first] & ~np.int64(0xFFFFFFFF)) | start
        none = np.zeros(len(gone_key), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([anchor[keep], none]), mask=np.concatenate([np.zeros(keep.sum(), bool), none == 0])),
                pa.array(np.concatenate([context[keep], none])),
                pa.array(np.concatenate([key[keep], gone_key])),
                pa.array(np.concatenate([place[keep], gone_place])),
                pa.array(np.concatenate([n[keep], end - start - LENGTH + 1]).astype(np.int32)),
            ],
            ["anchor", "context", "key", "place", "n"],
        )

    for batch in batches:
        keys, texts = batch.column("key"), batch.column("text")
        for i in range(batch.num_rows):
            data = texts[i].as_py().encode()
            if len(data) < LENGTH:
                continue
            mark = _mark(data) << 32
            key = keys[i].as_py()
            for anchor, first, last, _ in anchors(data):
                spans = zip(first.tolist(), (last + LENGTH).tolist(), strict=True)
                context = np.array([xxh3_64_intdigest(data[a:b]) for a, b in spans], np.uint64).view(np.int64)
                parts.append((anchor, context, np.full(len(first), key), first | mark, last - first + 1))
                held += len(first)
                if held >= CHUNK:
                    yield flush()
                    parts, held = [], 0
    if parts:
        yield flush()


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts in order of anchor, context and place: repeated ones, and those of buckets with several.

    ``anchor`` is null on the repeated ones. What a batch leaves open is its last bucket: its last context, and
    the bucket's only context so far, which is held back until a second one comes.
    """
    names = ["anchor", "key", "place", "n"]
    last: tuple[int, int, int, int] | None = None  # anchor and context of the last row; their first document and place
    single: np.ndarray | None = None  # the only row of the last bucket so far
    for batch in batches:
        bare = batch.column("anchor").null_count
        gone = batch.slice(0, bare)
        if bare:
            yield pa.RecordBatch.from_arrays([gone.column(c) for c in names], names)
        rest = batch.slice(bare)
        if not rest.num_rows:
            continue
        anchor, context = (rest.column(c).to_numpy() for c in ("anchor", "context"))
        rows = np.stack([rest.column(c).to_numpy().astype(np.int64) for c in names])
        before = last if last is not None else (~anchor[0], 0, 0, 0)
        same = np.concatenate([[before[0]], anchor[:-1]]) == anchor
        again = same & (np.concatenate([[before[1]], context[:-1]]) == context)
        head = np.maximum.accumulate(np.where(again, -1, np.arange(len(again))))
        first = [np.where(head < 0, carried, rows[c][head]) for c, carried in ((1, before[2]), (2, before[3]))]
        last = (int(anchor[-1]), int(context[-1]), int(first[0][-1]), int(first[1][-1]))
        # A row that repeats the first of its context in document and place is that very stretch.
        other = again & ((rows[1] != first[0]) | (rows[2] != first[1]))
        if other.any():
            columns = [pa.array(c) for c in rows[1:, other]]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(int(other.sum()), pa.int64()), *columns[:2], columns[2].cast(pa.int32())], names
            )
        new = rows[:, ~again]
        if not new.shape[1]:
            continue
        # Buckets that go on from the last batch have either a held row or several rows already sent.
        several_before = single is None and bool(before[0] == new[0, 0])
        if single is not None:
            new = np.concatenate([single, new], axis=1)
        bucket = np.concatenate([[0], np.cumsum(new[0, 1:] != new[0, :-1])])
        sizes = np.bincount(bucket)
        many = sizes > 1
        if several_before:
            many[0] = True
        held = not many[-1]
        single = new[:, -1:] if held else None
        sent = new[:, many[bucket]]
        if sent.shape[1]:
            columns = [pa.array(c) for c in sent]
            yield pa.RecordBatch.from_arrays([*columns[:3], columns[3].cast(pa.int32())], names)


def cover_ranks(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Ranks of the ``PERIOD`` bytes at each position; equal blocks have equal ranks."""
    blocks = np.lib.stride_tricks.sliding_window_view(data, PERIOD)[positions]
    words = np.ascontiguousarray(blocks).view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    ordered = words[order]
    new = np.concatenate([[0], np.any(ordered[1:] != ordered[:-1], axis=1)]) if len(order) else order
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def sort_suffixes(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by bucket and content to depth ``LENGTH``, and which equal the one before.

    ``bucket`` numbers in order. Suffixes of a bucket that are equal lie alike to the period, since contexts are laid out with
    their anchors at one residue. The first ``PERIOD`` bytes and the last are compared directly; what lies between is
    covered by the ranks of two blocks at a position of the cover, found from the residue alone.
    """
    view = np.lib.stride_tricks.sliding_window_view(data, PERIOD)

    def direct(at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(view[at]).view(">u8").astype(np.uint64)

    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    # For each residue the least step of 4 to 32 that leads to the cover.
    steps = np.array([next(d for d in range(4, PERIOD + 1) if inside[(r + d) % PERIOD]) for r in range(PERIOD)])
    sample = np.flatnonzero(inside[np.arange(len(data) - PERIOD + 1) % PERIOD])
    rank_at = np.zeros(len(data), np.int64)
    rank_at[sample] = cover_ranks(data, sample)
    residue = starts % PERIOD
    cover = starts + steps[residue]
    keys = [
        bucket,
        *direct(starts).T,
        residue,
        rank_at[cover],
        rank_at[cover + PERIOD],
        *direct(starts + LENGTH - PERIOD).T,
    ]
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order), bool)
    if len(order):
        same[0] = False
        for key in keys:
            ordered = key[order]
            same[1:] &= ordered[1:] == ordered[:-1]
    return order, same


def _sorted_block(rows: list[tuple[int, int, int, int, int, bytes]]) -> Iterator[tuple[int, int, int]]:
    """Repeated stretches (key, place, number of suffixes) among whole buckets of (anchor, key, place, n, lead, bytes)."""
    # Each context starts where its anchor comes to lie at residue 0.
    starts, at = [], 0
    pieces: list[bytes] = []
    for _, _, _, _, lead, data in rows:
        pad = -(at + lead) % PERIOD
        pieces += [b"\0" * pad, data]
        starts.append(at + pad)
        at += pad + len(data)
    data = np.frombuffer(b"".join([*pieces, b"\0" * (2 * PERIOD)]), np.uint8)
    anchor, key, place, n = (np.array(c, np.int64) for c in list(zip(*rows, strict=True))[:4])
    bucket = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]]))
    row = np.repeat(np.arange(len(rows)), n)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    order, same = sort_suffixes(data, np.array(starts)[row] + shift, bucket[row])
    # Of equal suffixes the first by document and place stays.
    group = np.cumsum(~same)
    order = order[np.lexsort((place[row[order]] + shift[order], key[row[order]], group))]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    own = (key[row[order]] == key[row[head]]) & (place[row[order]] + shift[order] == place[row[head]] + shift[head])
    gone = np.sort(order[~own])
    if not len(gone):
        return
    run = np.concatenate([[True], (gone[1:] != gone[:-1] + 1) | (row[gone[1:]] != row[gone[:-1]])])
    heads = np.flatnonzero(run)
    sizes = np.diff(np.concatenate([heads, [len(gone)]]))
    for head, size in zip(gone[heads].tolist(), sizes.tolist(), strict=True):
        yield int(key[row[head]]), int(place[row[head]] + shift[head]), size


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets, in the order of their anchors, sorted in blocks of bounded size."""
    rows: list[tuple] = []
    held = 0

    def flush(block: list[tuple]) -> pa.RecordBatch:
        found = list(_sorted_block(block))
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "place", "n"]
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held > SORT_BYTES and row[0] != rows[-1][0]:
                yield flush(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[5])
    if rows:
        yield flush(rows)


def _packed(docs: DataFrame) -> DataFrame:
    """Texts in compressed form, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column("text")]
            marks = pa.array([_mark(t) for t in texts], pa.int64())
            data = pa.array([press.compress(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), marks, data], ["key", "mark", "data"])

    return docs.mapInArrow(run, "key long, mark long, data binary")


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open context of a text: whole for buckets that are sorted, a hash per suffix for the others."""
    from xxhash import xxh3_128_digest

    names = ["anchor", "key", "place", "n", "lead", "data"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for i in range(batch.num_rows):
            data = _unpack(batch.column("data")[i].as_py())
            key = batch.column("key")[i].as_py()
            open_ = batch.column("open")[i].as_py()
            leads = {}
            for _, first, _, place in anchors(data):
                leads.update(zip(first.tolist(), (place - first).tolist(), strict=True))
            for x in open_:
                start = x["place"] & 0xFFFFFFFF
                if x["hot"]:
                    for j in range(x["n"]):
                        stretch = xxh3_128_digest(data[start + j : start + j + LENGTH])
                        rows.append((None, key, x["place"] + j, 1, 0, stretch))
                else:
                    stretch = data[start : start + x["n"] + LENGTH - 1]
                    rows.append((x["anchor"], key, x["place"], x["n"], leads[start], stretch))
                held += x["n"] + LENGTH
            if held > 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def repeats(docs: DataFrame) -> DataFrame:
    """From (key, text): removed stretches (key, place, n), n suffixes of ``LENGTH`` bytes from a place on.

    ``place`` has the text's mark above 32 bits of its start.
    """
    found = docs.mapInArrow(_contexts, "anchor long, context long, key long, place long, n int")
    dealt = found.repartition(F.coalesce("anchor", "place")).sortWithinPartitions("anchor", "context", "key", "place")
    met = cut_lineage(dealt.mapInArrow(_repeats, "anchor long, key long, place long, n int"), "repeats")
    gone = met.where("anchor is null").select("key", "place", "n")
    open_ = met.where("anchor is not null")
    hot = open_.groupBy("anchor").count().where(F.col("count") > BUCKET).select("anchor", F.lit(True).alias("hot"))
    open_ = open_.join(small(hot), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    listed = open_.groupBy("key", F.shiftright("place", 32).alias("mark")).agg(F.collect_list(F.struct("anchor", "place", "n", "hot")).alias("open"))
    held = docs.join(small(open_.select("key").distinct()), "key", "left_semi")
    rows = _packed(held).join(listed, ["key", "mark"]).mapInArrow(
        _cut, "anchor long, key long, place long, n int, lead int, data binary"
    )
    rows = cut_lineage(rows, "suffixes")
    buckets = rows.where("anchor is not null").repartition("anchor").sortWithinPartitions("anchor")
    gone = gone.unionByName(buckets.mapInArrow(_sorted, "key long, place long, n int"))
    alone = rows.where("anchor is null").select("data", "key", "place", "n")
    least = alone.groupBy("data").agg(F.min(F.struct("key", "place")).alias("least"))
    later = alone.join(least, "data").where(F.struct("key", "place") > F.col("least"))
    return gone.unionByName(later.select("key", "place", "n"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            data = _unpack(batch.column("data")[i].as_py())
            places = sorted((x["place"], x["n"]) for x in batch.column("gone")[i].as_py() or [])
            start = np.array([p & 0xFFFFFFFF for p, _ in places], np.int64)
            end = start + np.array([n for _, n in places], np.int64) + LENGTH - 1
            _, start, end = _merged(np.zeros(len(start), np.int64), start, end)
            kept, at = [], 0
            for a, b in zip(start.tolist(), end.tolist(), strict=True):
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            rows.append((len(data), int((end - start).sum()), len(start), b"".join(kept)))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay.

    Removed is each byte of a stretch of ``LENGTH`` bytes that also starts earlier: in a document with a smaller id, or in the
    same one before; stretches are judged on the input and may overlap themselves. Ids are whole numbers; rows without one
    come after all others. A null text is empty. Rows alike in id and text are one document and get its result each; other
    rows that share an id are ordered by a hash of their text.
    """
    key = F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(int(NO_ID)))
    texts = docs.select(key.alias("key"), text_of(text_col).alias("text"))
    gone = repeats(texts.where(F.octet_length("text") >= LENGTH))
    listed = cut_lineage(
        gone.groupBy("key", F.shiftright("place", 32).alias("mark")).agg(F.collect_list(F.struct("place", "n")).alias("gone")), "gone"
    )
    touched = small(listed.select("key").distinct())
    packed = _packed(texts.join(touched, "key", "left_semi"))
    cut = packed.join(listed, ["key", "mark"], "left").mapInArrow(
        _remove, "key long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    whole = texts.join(touched, "key", "left_anti").select(
        "key",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    both = cut.unionByName(whole)
    return both.select(
        F.nullif("key", F.lit(int(NO_ID))).cast(docs.schema[id_col].dataType).alias(id_col),
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept",
    )

