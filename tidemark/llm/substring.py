"""Near-duplicate passages across documents by compact windows over min-hashes.

For each of a few hash functions the Cartesian tree over a document's shingle hashes groups its subsequences by their
min-hash: a node with the least hash at c and the range from l to r stands for every subsequence from l..c to c..r. Nodes
as long as a passage are its compact windows. Windows of two documents that share a min-hash are aligned at it; where windows of
enough hash functions overlap along one alignment, the stretch is a candidate, and its shingles are compared.

Windows that share a min-hash are linked to the first of them. Where the words around the min-hash differ from the first one's, that
one may hold another passage; such windows are grouped once more by the min-hash with what stands to its left, and to its
right, so that two of them meet even if the first is like neither.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, small, text_of
from tidemark.llm.components import components
from tidemark.session import cut_lineage

SHINGLE = 5
MIN_WORDS = 50
SIMILARITY = 0.8
#: Hash functions, at most 8, and how many must meet along one alignment.
HASHES = 4
ENOUGH = 2
#: Shingles by which two alignments of one passage may differ.
DRIFT = 16
#: Shingles on one side of a min-hash that make up its context.
CONTEXT = 16
#: Words of the texts whose windows are found at a time.
BLOCK = 1 << 16
#: Windows gathered before those with equal min-hashes are linked to the first of them.
CHUNK = 1 << 19
#: Bounds of fetched stretches are rounded to multiples of this, so that many candidates share one.
GRID = 64
#: Common shingles whose pairs of ends are tried at a time, and the longest of these that are compared.
SPAN, TRIED = 512, 8
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashed(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_digest

    digests = (b"".join(map(xxh3_64_digest, words[i : i + BLOCK])) for i in range(0, len(words), BLOCK))
    return np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(d, ">u8").astype(np.uint64) for d in digests)])


def _words(text: str) -> list[bytes]:
    """A-Z in lower case, words between ASCII white space."""
    return text.encode().lower().split()


def _rolled(each: np.ndarray) -> np.ndarray:
    """A hash of each run of ``SHINGLE`` hashes of words."""
    n = len(each) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total ^= each[k : k + n]
        total *= _BASE
        total ^= total >> np.uint64(32)
    return total


def shingles(text: str) -> np.ndarray:
    """A hash of each run of ``SHINGLE`` words of a text."""
    return _rolled(_hashed(_words(text)))


def permuted(marks: np.ndarray, function: int) -> np.ndarray:
    """The hashes of one function; its number fills the low three bits."""
    seed = np.uint64((0x1234567 * (2 * function + 1)) & (2**64 - 1))
    h = (marks ^ seed) * _MIX
    h ^= h >> np.uint64(29)
    h *= _BASE
    h ^= h >> np.uint64(32)
    return h & ~np.uint64(7) | np.uint64(function)


def _slid(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least, or greatest, of every ``width`` neighbours; ``pick`` is ``np.minimum`` or ``np.maximum``."""
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[:-rest], values[rest:]) if rest else values


def compact_windows(h: np.ndarray, least: int) -> np.ndarray:
    """Rows (l, c, r), r included, by c: the nodes of the Cartesian tree over ``h`` with ``least`` places or more.

    Such a node is the least of some ``least`` neighbours, and so are the nodes above it, the first smaller ones on its left and right.
    So the tree is built over the places that are least somewhere; of equal ones the first is the node above.
    """
    if len(h) < least:
        return np.zeros((0, 3), np.int64)
    edge = np.zeros(least - 1, h.dtype)
    lows = np.concatenate([edge, _slid(h, least, np.minimum), edge])
    places = np.flatnonzero(h == _slid(lows, least, np.maximum))
    values = h[places].tolist()
    left, right = [-1] * len(values), [len(values)] * len(values)
    above: list[int] = []
    for n, value in enumerate(values):
        while above and values[above[-1]] > value:
            right[above.pop()] = n
        if above:
            left[n] = above[-1]
        above.append(n)
    ends = np.concatenate([places, [len(h), -1]])
    windows = np.stack([ends[left] + 1, places, ends[right] - 1], axis=1)
    return windows[windows[:, 2] - windows[:, 0] + 1 >= least]


MEMBER = ["key", "id", "c", "l", "r", "context"]
NAMES = [*MEMBER, "seed", "rep", "rep_c", "rep_l", "rep_r"]
WINDOW_SCHEMA = (
    "key long, id long, c int, l int, r int, context long, seed boolean, rep long, rep_c int, rep_l int, rep_r int"
)
_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())


def contexts(marks: np.ndarray, places: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 bits for the shingles on the left of each place, above 32 bits for those on its right, both with the place itself.

    ``start`` and ``end`` (not included) bound the text of each place.
    """
    total = np.concatenate([[np.uint64(0)], np.cumsum((marks ^ (marks >> np.uint64(29))) * _MIX, dtype=np.uint64)])
    low, high = np.maximum(places - CONTEXT, start), np.minimum(places + CONTEXT + 1, end)
    left, right = (total[places + 1] - total[low]) * _BASE, (total[high] - total[places]) * _BASE
    return (left & np.uint64(0xFFFFFFFF00000000) | right >> np.uint64(32)).view(np.int64)


def _rows(members: np.ndarray, heads: np.ndarray | None, seed: bool = False) -> pa.RecordBatch:
    n = members.shape[1]
    columns = [pa.array(c, k, safe=False) for c, k in zip(members, _KINDS, strict=True)]
    columns.append(pa.array(np.full(n, seed)))
    if heads is None:
        columns += [pa.nulls(n, k) for k in _KINDS[1:5]]
    else:
        columns += [pa.array(c, k, safe=False) for c, k in zip(heads[1:5], _KINDS[1:5], strict=True)]
    return pa.RecordBatch.from_arrays(columns, NAMES)


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of key, document and place, and which are the first of their key."""
    rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    return rows, np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])


def _star(rows: np.ndarray, first: np.ndarray) -> tuple[Iterator[pa.RecordBatch], np.ndarray]:
    """Links of all but the first row of each key to it, and each row's first."""
    head = rows[:, np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
    other = rows[1] != head[1]
    return iter([_rows(rows[:, other], head[:, other])] if other.any() else []), head


def _seeds(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows under their min-hash with its left or right context, where wanted; the function stays in the low bits.

    Of windows that meet here only the first goes on, the others are linked to it.
    """
    found = []
    for wanted, shift, salt in ((left, 32, 1), (right, 0, 2)):
        some = rows[:, wanted].copy()
        side = (some[5].view(np.uint64) >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)
        key = some[0].view(np.uint64)
        mixed = (key ^ (side + np.uint64(salt << 40)) * _BASE) * _MIX
        mixed ^= mixed >> np.uint64(32)
        some[0] = (mixed & ~np.uint64(7) | key & np.uint64(7)).view(np.int64)
        found.append(some)
    seeds = np.concatenate(found, axis=1)
    if seeds.shape[1]:
        seeds, first = _sorted(seeds)
        yield _rows(seeds[:, first], None, True)
        yield from _star(seeds, first)[0]


def _apart(rows: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of another document than their key's first whose left, or right, context differs from its."""
    other = rows[1] != head[1]
    return other & (rows[5] >> 32 != head[5] >> 32), other & (rows[5] & 0xFFFFFFFF != head[5] & 0xFFFFFFFF)


def _members(each: np.ndarray, counts: list[int], ids: list[int], least: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of some texts, given their words' hashes one text after the other, and the number of each window's text."""
    marks = _rolled(each)
    ends = np.cumsum(counts)
    starts, keys = ends - counts, np.array(ids, np.int64)
    # Runs of words that reach from one text into the next one bound the windows of both.
    across = (ends[:-1, None] - np.arange(1, SHINGLE)).ravel()
    ends = ends - SHINGLE + 1
    rows, texts = [], []
    for f in range(hashes):
        h = np.maximum(permuted(marks, f), np.uint64(8 + f))
        h[across] = 0
        low, places, high = compact_windows(h, least).T
        text = np.searchsorted(starts, places, "right") - 1
        start, end = starts[text], ends[text]
        own = places < end
        low, places, high, text, start, end = (x[own] for x in (low, places, high, text, start, end))
        context = contexts(marks, places, start, end)
        rows.append(np.stack([h[places].view(np.int64), keys[text], places - start, low - start, high - start, context]))
        texts.append(text)
    return np.concatenate(rows, axis=1), np.concatenate(texts)


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Hashes of the words of some texts, their numbers of words, and their ids; texts without a window are left out."""
    each: list[np.ndarray] = []
    counts: list[int] = []
    ids: list[int] = []
    held = 0
    for batch in batches:
        for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
            words = _words(text.as_py())
            if len(words) - SHINGLE + 1 < least:
                continue
            each.append(_hashed(words))
            counts.append(len(words))
            ids.append(key.as_py())
            held += len(words)
            if held >= BLOCK:
                yield np.concatenate(each), counts, ids
                each, counts, ids, held = [], [], [], 0
    if ids:
        yield np.concatenate(each), counts, ids


def _windows(least: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows, first = _sorted(np.concatenate(parts, axis=1))
            # In a run of one shingle every place has the same min-hash; the first window holds the others.
            again = np.all(rows[[0, 1, 5], 1:] == rows[[0, 1, 5], :-1], axis=0) & (rows[2, 1:] - rows[2, :-1] < least)
            kept = np.concatenate([[True], ~again])
            rows, first = rows[:, kept], first[kept]
            yield _rows(rows[:, first], None)
            links, head = _star(rows, first)
            yield from links
            yield from _seeds(rows, *_apart(rows, head))

        for each, counts, ids in _blocks(batches, least):
            rows, text = _members(each, counts, ids, least, hashes)
            total = held + np.cumsum(np.bincount(text, minlength=len(ids)))
            while total[-1] >= CHUNK:
                full = int(np.searchsorted(total, CHUNK))
                parts.append(rows[:, text <= full])
                yield from flush()
                parts = []
                rows, text = rows[:, text > full], text[text > full]
                total = total - total[full]
            parts.append(rows)
            held = int(total[-1])
        if held:
            yield from flush()

    return run


def _links(seeds: bool):
    """From windows in order of key and id, those without a partner linked to the first of their key; others pass.

    With ``seeds`` all windows of a key that has several are given on under their contexts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: np.ndarray | None = None  # the first window of the last key
        known = False  # whether its seeds are given on already
        for batch in batches:
            done = pc.or_(batch.column("rep").is_valid(), batch.column("seed")) if seeds else batch.column("rep").is_valid()
            passed = batch.filter(done)
            if passed.num_rows:
                yield passed
            rest = batch.filter(pc.invert(done))
            if not rest.num_rows:
                continue
            rows = np.stack([rest.column(c).to_numpy().astype(np.int64) for c in MEMBER])
            if carried is not None:
                rows = np.concatenate([carried, rows], axis=1)
            first = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
            starts = np.flatnonzero(first)
            sizes = np.diff(np.concatenate([starts, [len(first)]]))
            links, head = _star(rows, first)
            yield from links
            if seeds:
                left, right = _apart(rows, head)
                # The first of a key is wanted once, as soon as another one is there.
                heads = starts[sizes > 1]
                if known and len(heads) and heads[0] == 0:
                    heads = heads[1:]
                left[heads] = right[heads] = True
                yield from _seeds(rows, left, right)
                known = bool(sizes[-1] > 1) or (known and len(starts) == 1)
            carried = rows[:, starts[-1] : starts[-1] + 1]

    return run


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Half of each shingle's hash, for the stretch s..e of a text; rows of one text come one after the other."""
    last: tuple[str, np.ndarray] | None = None
    for batch in batches:
        data = []
        for text, s, e in zip(*(batch.column(c) for c in ("text", "s", "e")), strict=True):
            text = text.as_py()
            if last is None or last[0] != text:
                last = (text, (shingles(text) >> np.uint64(32)).astype("<u4"))
            data.append(last[1][s.as_py() : e.as_py()].tobytes())
        names = ["id", "s", "e"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(data, pa.binary())], [*names, "data"])


def _held(marks: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which marks are among the others; of a few hundred, a search in sorted ones is quicker than ``np.isin``."""
    if not len(others):
        return np.zeros(len(marks), bool)
    ranked = np.sort(others)
    return ranked[np.minimum(np.searchsorted(ranked, marks), len(ranked) - 1)] == marks


def _distinct(marks: np.ndarray) -> np.ndarray:
    ranked = np.sort(marks)
    return np.concatenate([ranked[:1], ranked[1:][ranked[1:] != ranked[:-1]]])


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    one, two = _distinct(a), _distinct(b)
    both = int(np.count_nonzero(_held(one, two)))
    return both / max(1, len(one) + len(two) - both)


def _longest(hit: np.ndarray, share: float) -> tuple[int, int]:
    """The longest part of which at least this share are hits, from its first hit to its last: start and end."""
    total = np.concatenate([[0.0], np.cumsum(np.where(hit, 1 - share, -share))])
    low = np.minimum.accumulate(total)
    # For each end the first start from which the sum is not negative.
    start = np.searchsorted(-low, -(total + 1e-9))
    end = int(np.argmax(np.arange(len(total)) - start))
    inside = np.flatnonzero(hit[start[end] : end])
    if not len(inside):
        return 0, 0
    return int(start[end] + inside[0]), int(start[end] + inside[-1]) + 1


def passages(a: np.ndarray, b: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """Parts (a0, a1, b0, b1, Jaccard) of two stretches that are similar enough.

    Two equally long parts of that similarity hold a share 2s / (1 + s) of each other. The longest part of ``a`` where this share
    is reached is looked for first, then what lies on either side; a part that turns out not to be similar
    enough is searched again for denser ones, in the end for runs that stand in ``b`` word for word.
    """
    share = 2 * similarity / (1 + similarity)
    levels = [share, (1 + share) / 2, 1.0]
    hits = _held(a, b)
    out = []
    todo = [(0, len(a), 0)]
    while todo:
        lo, hi, level = todo.pop()
        if hi - lo < least:
            continue
        x, y = _longest(hits[lo:hi], levels[level])
        x, y = x + lo, y + lo
        if y - x < least * similarity:
            if level + 1 < len(levels):
                todo.append((lo, hi, level + 1))
            continue
        found = _counterpart(a[x:y], b, least, similarity)
        if found:
            p, q, u, v, alike = found
            out.append((x + p, x + q, u, v, alike))
        elif level + 1 < len(levels):
            todo.append((x, y, level + 1))
        todo += [(lo, x, level), (y, hi, level)]
    return out


def _counterpart(
    part: np.ndarray, b: np.ndarray, least: int, similarity: float
) -> tuple[int, int, int, int, float] | None:
    """Where ``part`` stands in ``b``, as (part0, part1, b0, b1, Jaccard), if similar enough."""
    share = 2 * similarity / (1 + similarity)
    u, v = _longest(_held(b, part), share)
    p, q = _longest(_held(part, b[u:v]), share)
    alike = _jaccard(part[p:q], b[u:v])
    return (p, q, u, v, alike) if alike >= similarity and min(q - p, v - u) >= least else None


def _chain(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal shingles that rise in both: the n-th of a kind in ``a`` with the n-th in ``b``, as many as do."""

    def numbered(marks: np.ndarray) -> np.ndarray:
        order = np.argsort(marks, kind="stable")
        ranked = marks[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        at = np.arange(len(marks))
        number = np.empty(len(marks), np.uint64)
        number[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        return marks.astype(np.uint64) << np.uint64(32) | number

    _, i, j = np.intersect1d(numbered(a), numbered(b), assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    if np.all(j[1:] > j[:-1]):
        return i, j
    tails: list[int] = []
    ends: list[int] = []
    before = np.full(len(j), -1)
    for n, place in enumerate(j.tolist()):
        at = bisect_left(tails, place)
        before[n] = ends[at - 1] if at else -1
        tails[at : at + 1], ends[at : at + 1] = [place], [n]
    kept, n = [], ends[-1]
    while n >= 0:
        kept.append(n)
        n = before[n]
    return i[kept[::-1]], j[kept[::-1]]


def _padded(first: int, last: int, least: int, size: int) -> tuple[int, int]:
    """The part from ``first`` to ``last``, widened to ``least`` places of ``size``."""
    first = max(0, min(first, size - least))
    return first, max(last + 1, first + least)


def _aligned(a: np.ndarray, b: np.ndarray, least: int, similarity: float) -> tuple[int, int, int, int, float] | None:
    """The longest similar parts (a0, a1, b0, b1, Jaccard) along one alignment, of any two lengths from ``least``.

    Parts that are as similar as can be begin and end with shingles of both, but for those widened to ``least``; so all pairs of
    such ends are tried. Where parts are similar, the first or second half of them is, too: of a long chain near ends do.
    """
    if min(len(a), len(b)) < least:
        return None
    i, j = _chain(a, b)
    found: list[tuple[int, int, int]] = []
    for low in range(0, len(i), SPAN):
        begin, end = np.arange(low, min(low + SPAN, len(i)))[:, None], np.arange(low, min(low + 4 * SPAN, len(i)))[None, :]
        both = end - begin + 1
        wide = np.maximum(i[end] - i[begin] + 1, least) + np.maximum(j[end] - j[begin] + 1, least)
        good = (both > 0) & (both >= similarity * (wide - both) - 1e-9)
        for at in np.argsort(-np.where(good, both, 0), axis=None)[:TRIED]:
            x, y = np.unravel_index(at, good.shape)
            if good[x, y]:
                found.append((int(both[x, y]), int(begin[x, 0]), int(end[0, y])))
    for _, x, y in sorted(found, reverse=True):
        (p, q), (u, v) = _padded(int(i[x]), int(i[y]), least, len(a)), _padded(int(j[x]), int(j[y]), least, len(b))
        alike = _jaccard(a[p:q], b[u:v])
        if alike >= similarity:
            return p, q, u, v, alike
    return None


def _rest(
    a: np.ndarray, b: np.ndarray, taken: list[tuple[int, int, int, int, float]], least: int, similarity: float
) -> list[tuple[int, int, int, int, float]]:
    """Similar parts in what ``taken`` leaves of ``a``: parts of different lengths, and such as end in edited words."""
    ends = sorted((x, y) for x, y, *_ in taken)
    todo = list(zip([0, *(y for _, y in ends)], [*(x for x, _ in ends), len(a)], strict=True))
    known = _held(a, b)
    out = []
    while todo:
        lo, hi = todo.pop()
        if hi - lo < least or known[lo:hi].sum() < least * similarity:
            continue
        found = _aligned(a[lo:hi], b, least, similarity)
        if found:
            p, q, u, v, alike = found
            out.append((lo + p, lo + q, u, v, alike))
            todo += [(lo, lo + p), (lo + q, hi)]
    return out


def _verify(least: int, similarity: float):
    kinds = (pa.int64(),) * 6 + (pa.float64(),)
    names = ["id", "start", "end", "rep", "rep_start", "rep_end", "similarity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, rep, a0, a1, b0, b1, sa, sb, da, db = row
                whole, other = np.frombuffer(da, "<u4"), np.frombuffer(db, "<u4")
                x0, u0, x1, u1 = max(sa, a0 - DRIFT), max(sb, b0 - DRIFT), a1 + DRIFT, b1 + DRIFT
                wide, beside = whole[x0 - sa : x1 + 1 - sa], other[u0 - sb : u1 + 1 - sb]
                # Most stretches share a phrase only.
                if _held(wide, beside).sum() < least * similarity:
                    continue
                words = SHINGLE - 1
                a, b = whole[a0 - sa : a1 + 1 - sa], other[b0 - sb : b1 + 1 - sb]
                found = passages(a, b, least, similarity)
                for x, y, u, v, alike in found:
                    rows.append((key, a0 + x, a0 + y + words, rep, b0 + u, b0 + v + words, alike))
                # A passage with more words on one side of the min-hash than in the other document reaches beyond the stretch.
                if found:
                    x0, u0 = a0, b0
                else:
                    a, b = wide, beside
                for x, y, u, v, alike in _rest(a, b, found, least, similarity):
                    rows.append((key, x0 + x, x0 + y + words, rep, u0 + u, u0 + v + words, alike))
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def candidates(texts: DataFrame, least: int, hashes: int, enough: int) -> DataFrame:
    """(id, rep, a0, a1, b0, b1): stretches of shingles that windows of ``enough`` functions align with another document."""
    found = texts.mapInArrow(_windows(least, hashes), WINDOW_SCHEMA)
    # Links made within a task need no partner any more and go anywhere, as do seeds, which are dealt later.
    settled = F.col("rep").isNotNull() | F.col("seed")
    place = F.when(settled, F.xxhash64("id", "c")).otherwise(F.col("key"))
    order = ["key", "id", "c"]
    dealt = found.repartition(place).sortWithinPartitions(*order)
    met = cut_lineage(dealt.mapInArrow(_links(True), WINDOW_SCHEMA), "windows")
    seeds = met.where("seed").repartition("key").sortWithinPartitions(*order)
    linked = met.where("not seed").unionByName(seeds.mapInArrow(_links(False), WINDOW_SCHEMA))
    left, right = F.least(F.expr("c - l"), F.expr("rep_c - rep_l")), F.least(F.expr("r - c"), F.expr("rep_r - rep_c"))
    aligned = (
        linked
        .select("key", "id", "rep", "c", "rep_c", left.alias("left"), right.alias("right"))
        .where(F.col("left") + F.col("right") + 1 >= least)
        .select(
            "id",
            "rep",
            F.expr("c - rep_c").alias("shift"),
            F.expr("c - left").alias("a0"),
            F.expr("c + right").alias("a1"),
            F.expr("rep_c - left").alias("b0"),
            F.expr("rep_c + right").alias("b1"),
            F.expr("shiftleft(1, int(key & 7))").alias("function"),
        )
    )
    # Alignments of a pair of documents, a new one wherever the shift jumps; then overlapping stretches of each.
    pair = Window.partitionBy("id", "rep").orderBy("shift", "a0")
    jump = F.coalesce(F.col("shift") - F.lag("shift").over(pair) > DRIFT, F.lit(False))
    aligned = aligned.withColumn("jump", jump.cast("int")).withColumn("line", F.sum("jump").over(pair))
    line = Window.partitionBy("id", "rep", "line").orderBy("a0", "a1")
    reach = F.max("a1").over(line.rowsBetween(Window.unboundedPreceding, -1))
    aligned = aligned.withColumn("gap", F.coalesce(F.col("a0") > reach, F.lit(False)).cast("int"))
    aligned = aligned.withColumn("part", F.sum("gap").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    parts = aligned.groupBy("id", "rep", "line", "part").agg(
        F.min("a0").alias("a0"),
        F.max("a1").alias("a1"),
        F.min("b0").alias("b0"),
        F.max("b1").alias("b1"),
        F.bit_or("function").alias("functions"),
    )
    return parts.where(F.bit_count("functions") >= enough).drop("line", "part", "functions")


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    enough: int = ENOUGH,
) -> DataFrame:
    """One row per passage that a document shares with the first document found to hold it.

    Words ``start_word`` to ``end_word`` (not included) of the document and ``other_start`` to ``other_end`` of ``other_id``, at
    least ``min_words`` each, have a Jaccard similarity of at least ``similarity`` by runs of five words. ``class_id`` is the
    smallest id that such rows connect. Documents that hold one passage are each linked to a representative, so a
    group of copies gives a row per copy, not per pair. Ids are whole numbers; rows without id or with fewer words have no
    rows; rows that share an id are not compared with each other. Null texts are empty.

    Windows that meet within a task are linked there; a min-hash that very many documents share sends one window per task, and
    its contexts are grouped apart.
    """
    least = min_words - SHINGLE + 1
    key = F.col(quoted(id_col)).cast("long")
    texts = docs.where(key.isNotNull()).select(key.alias("id"), text_of(text_col).alias("text"))
    parts = cut_lineage(candidates(texts, least, hashes, enough), "passages")
    for side, s, e in (("a", "a0", "a1"), ("b", "b0", "b1")):
        parts = parts.withColumns(
            {
                f"s{side}": F.floor(F.greatest(F.col(s) - DRIFT, F.lit(0)) / GRID) * GRID,
                f"e{side}": (F.floor((F.col(e) + DRIFT) / GRID) + 1) * GRID,
            }
        )
    needs = (
        parts.select("id", F.col("sa").alias("s"), F.col("ea").alias("e"))
        .unionByName(parts.select(F.col("rep").alias("id"), F.col("sb").alias("s"), F.col("eb").alias("e")))
        .distinct()
    )
    needs = cut_lineage(needs, "needs")
    wanted = texts.join(small(needs.select("id").distinct()), "id", "left_semi")
    fetched = wanted.join(small(needs), "id").mapInArrow(_stretches, "id long, s long, e long, data binary")
    fetched = cut_lineage(fetched.dropDuplicates(["id", "s", "e"]), "stretches")
    one = fetched.select(F.col("id"), F.col("s").alias("sa"), F.col("e").alias("ea"), F.col("data").alias("da"))
    two = fetched.select(F.col("id").alias("rep"), F.col("s").alias("sb"), F.col("e").alias("eb"), F.col("data").alias("db"))
    joined = parts.join(one, ["id", "sa", "ea"]).join(two, ["rep", "sb", "eb"])
    columns = ["id", "rep", "a0", "a1", "b0", "b1", "sa", "sb", "da", "db"]
    schema = "id long, start long, end long, rep long, rep_start long, rep_end long, similarity double"
    found = cut_lineage(joined.select(columns).mapInArrow(_verify(least, similarity), schema), "verified")
    roots = components(found.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    return found.join(roots, F.col("id") == F.col("node")).select(
        F.col("id").alias(id_col),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        F.col("rep").alias("other_id"),
        F.col("rep_start").alias("other_start"),
        F.col("rep_end").alias("other_end"),
        "similarity",
        F.col("root").alias("class_id"),
    )
