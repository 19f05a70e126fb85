"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the longest rules of the model's compiled character map, and every character of the result
remembers the source byte it came from. The result is merged into pieces, whose ends in the source are read off there.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, text_of

SPACE = "▁"
LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]")
LOST = "�"
#: Longer texts are encoded in parts, cut where no piece can reach across.
PART_CHARS = 1 << 18
#: Distinct stretches remembered by a worker, and the longest one among them.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64

# Numbers of the fields and kinds of pieces in the published model format.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at : at + size]
        at += size


class CharacterMap:
    """The rules of a compiled character map: a double-array trie over UTF-8 keys, and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size :]
        # Most characters start no rule; those are copied in runs.
        starts = {chr(c) for c in range(0x80) if self._child(0, c) is not None}
        leads = [c for c in range(0xC2, 0xF5) if self._child(0, c) is not None]
        for lead in leads:
            first, last = lead_range(lead)
            starts |= {chr(c) for c in range(first, last) if not 0xD800 <= c < 0xE000 and self._begins(chr(c))}
        self.candidates = re.compile("[" + "".join(map(re.escape, sorted(starts))) + "]") if starts else None

    def _child(self, node: int, byte: int) -> int | None:
        if not self.units:
            return None
        unit = self.units[node]
        node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6) ^ byte
        return node if node < len(self.units) and self.units[node] & ((1 << 31) | 0xFF) == byte else None

    def _begins(self, char: str) -> bool:
        node: int | None = 0
        for byte in char.encode():
            node = self._child(node, byte)
            if node is None:
                return False
        return True

    def longest(self, text: str, at: int) -> tuple[int, str] | None:
        """Length in characters and replacement of the longest rule that ``text`` has at ``at``."""
        node, best = 0, None
        for i in range(at, len(text)):
            for byte in text[i].encode():
                node = self._child(node, byte)
                if node is None:
                    return best
            unit = self.units[node]
            if unit >> 8 & 1:
                value = self.units[node ^ (unit >> 10) << ((unit & (1 << 9)) >> 6)] & ((1 << 31) - 1)
                best = i + 1 - at, self.texts[value : self.texts.index(b"\0", value)].decode()
        return best


def lead_range(lead: int) -> tuple[int, int]:
    """The code points whose UTF-8 form begins with the byte ``lead``."""
    if lead < 0xE0:
        return (lead & 31) << 6, ((lead & 31) + 1) << 6
    if lead < 0xF0:
        return max((lead & 15) << 12, 0x800), ((lead & 15) + 1) << 12
    return max((lead & 7) << 18, 0x10000), min(((lead & 7) + 1) << 18, 0x110000)


def byte_starts(text: str) -> np.ndarray:
    """The UTF-8 offset of each character of ``text``, and its end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    starts = np.zeros(len(points) + 1, np.int64)
    np.cumsum(widths, out=starts[1:])
    return starts


class Model:
    """A byte-pair model as the library writes it to a file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer, normalizer = {}, {}
        for number, value in fields(data):
            if number == PIECE:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == TRAINER:
                trainer |= dict(fields(value))
            elif number == NORMALIZER:
                normalizer |= dict(fields(value))
        self.kind = trainer.get(3, 1)
        self.suffix_space = bool(trainer.get(24, 0))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.rules = CharacterMap(normalizer.get(2, b""))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        self._index()

    def _index(self) -> None:
        self.ranks: dict[str, float] = {}
        self.known: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.bos = self.eos = self.unknown = -1
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if kind in (NORMAL, USER_DEFINED, UNUSED):
                self.ranks.setdefault(piece, -self.scores[i])
                self.known.setdefault(piece, i)
            elif kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
            elif piece == "<s>":
                self.bos = i
            elif piece == "</s>":
                self.eos = i
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        # A border inside no piece is never merged across.
        self.inside = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        lone = "".join(c for c in " \t\n\r\f\v" if not any(c in pair for pair in self.inside))
        words = not any(pair[1] == SPACE != pair[0] for pair in self.inside)
        self.cuts_at_spaces = words and self.escape and not self.squeeze and self.rules.candidates is None
        # A word is remembered without a mark that follows it, where no piece holds a letter before that mark.
        taken = {pair[1] for pair in self.inside if LETTER.match(pair)}
        marks = re.escape("".join(c for c in map(chr, range(33, 127)) if not LETTER.match(c) and c not in taken))
        word = f"{SPACE}*{LETTER.pattern}+(?=[{SPACE}{marks}]|$)|" if marks else ""
        lone = re.escape(lone)
        rest = f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" + (f"|[{lone}]" if lone else "")
        self.stretches = re.compile(word + rest) if words else None
        self.controls = {i for i, kind in enumerate(self.kinds) if kind == CONTROL}
        self.surfaces = []
        for piece, kind in zip(self.pieces, self.kinds, strict=True):
            text = self.unknown_text if kind == UNKNOWN else "" if kind == CONTROL else piece.replace(SPACE, " ")
            self.surfaces.append(bytes([int(piece[3:5], 16)]) if kind == BYTE else text.encode())
        self.cache: dict[str, bytes] = {}

    # Encoding.

    def normalise(self, text: str, first: bool = True) -> tuple[str, np.ndarray]:
        """The text as it is merged, and the source byte of each of its characters and of its end.

        ``first`` says whether ``text`` begins the document; only there a space is put in front.
        """
        if not text:
            return "", np.zeros(1, np.int64)
        sources = byte_starts(text)
        if self.rules.candidates is None:
            chars, froms = text, np.arange(len(text))
        else:
            chars, froms = self._replaced(text)
        stop = len(text)
        if self.squeeze:
            keep, lead = self._squeezed(chars)
            if len(keep) and keep[-1] + 1 < len(chars):
                stop = int(froms[keep[-1] + 1])
            if not len(keep):
                return "", np.zeros(1, np.int64)
            chars, froms = "".join(np.array(list(chars))[keep].tolist()), froms[keep]
        else:
            lead = 0
        if self.escape:
            chars = chars.replace(" ", SPACE)
        starts = np.append(sources[froms], sources[stop])
        if self.dummy_prefix and first:
            space = SPACE if self.escape else " "
            if self.suffix_space:
                return chars + space, np.append(starts[:-1], [starts[-1], starts[-1]])
            return space + chars, np.append(starts[:1] if lead else sources[:1], starts)
        return chars, starts

    def _replaced(self, text: str) -> tuple[str, np.ndarray]:
        parts, froms, at = [], [], 0
        for found in self.rules.candidates.finditer(text):
            i = found.start()
            if i < at:
                continue
            rule = self.rules.longest(text, i)
            if rule is None:
                continue
            parts += [text[at:i], rule[1]]
            froms += [np.arange(at, i), np.full(len(rule[1]), i)]
            at = i + rule[0]
        parts.append(text[at:])
        froms.append(np.arange(at, len(text)))
        return "".join(parts), np.concatenate(froms).astype(np.int64)

    def _squeezed(self, chars: str) -> tuple[np.ndarray, int]:
        """Places that stay when spaces at the ends and after a space go, and the number gone in front."""
        space = np.frombuffer(chars.encode("utf-32-le"), "<u4") == 32
        after = np.append(True, space[:-1])
        keep = np.flatnonzero(~(space & after))
        if len(keep) and space[keep[-1]]:
            keep = keep[:-1]
        return keep, int(keep[0]) if len(keep) else len(chars)

    def joined(self, symbols: list[str]) -> list[str]:
        """The characters of a short stretch after all merges."""
        rank = self.ranks.get
        ranks = [rank(a + b, inf) for a, b in pairwise(symbols)]
        while ranks and (best := min(ranks)) < inf:
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + symbols[i], inf)
            if i < len(ranks):
                ranks[i] = rank(symbols[i] + symbols[i + 1], inf)
        return symbols

    def joined_long(self, symbols: list[str]) -> list[str]:
        """The same by a queue of pairs, for stretches of any length."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                pair = symbols[left] + symbols[right]
                if pair in self.ranks:
                    heapq.heappush(heap, (self.ranks[pair], left, right, pair))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair or after[left] != right:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return list(filter(None, symbols))

    def merge(self, text: str) -> array:
        """Id and characters of each piece of a normalised stretch: the best pair is joined until none is known.

        The library's order: the greatest score first, the leftmost of equal ones. A character that is no piece
        becomes its bytes, of which the last one carries the character, or the unknown piece.
        """
        out = array("I")
        for symbol in (self.joined if len(text) <= CACHE_CHARS else self.joined_long)(list(text)):
            found = self.known.get(symbol)
            if found is not None:
                out.extend((found, len(symbol)))
            elif self.byte_fallback:
                for byte in symbol.encode():
                    out.extend((self.bytes[byte], 0))
                out[-1] = len(symbol)
            elif out and out[-2] == self.unknown:
                out[-1] += len(symbol)
            else:
                out.extend((self.unknown, len(symbol)))
        return out

    def stretch(self, text: str) -> bytes:
        """What ``merge`` gives, as 32-bit numbers; short stretches are remembered."""
        if len(text) > CACHE_CHARS and self.byte_fallback:
            cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.inside]
            if cuts:
                return self.stretches_of(text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True))
        found = self.merge(text).tobytes()
        if len(text) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[text] = found
        return found

    def stretches_of(self, texts: Iterable[str]) -> bytes:
        """The same for stretches that follow each other."""
        cached = self.cache.get
        return b"".join([cached(t) or self.stretch(t) for t in texts if t])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the byte where each piece begins and ends in it."""
        ids, starts, ends = [], [], []
        base = 0
        for n, part in enumerate(parts(text) if self.cuts_at_spaces else [text]):
            chars, sources = self.normalise(part, first=n == 0)
            # Unknown characters without bytes join across stretches, so such a text stays in one.
            whole = not self.byte_fallback or self.stretches is None
            found = self.stretches_of([chars] if whole else self.stretches.findall(chars))
            marks, sizes = np.frombuffer(found, "u4").reshape(-1, 2).T
            sizes = sizes.astype(np.int64)
            at = np.zeros(len(sizes) + 1, np.int64)
            np.cumsum(sizes, out=at[1:])
            ids.append(marks)
            starts.append(sources[at[:-1]] + base)
            ends.append(np.where(sizes > 0, sources[at[1:]], sources[at[:-1]]) + base)
            base += int(byte_starts(part)[-1]) if self.cuts_at_spaces else 0
        join = lambda arrays, kind: np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)
        return join(ids, "<u4"), join(starts, "<i8"), join(ends, "<i8")

    # Decoding.

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids.

        Control pieces are empty, the space in front of the first text goes, and byte pieces that follow
        each other form characters; a byte that is part of none becomes U+FFFD.
        """
        ids = ids.tolist()
        shown = [self.surfaces[i] for i in ids]
        if self.dummy_prefix or self.squeeze:
            for n, i in enumerate(ids):
                if self.kinds[i] == CONTROL:
                    continue
                if self.kinds[i] not in (BYTE, UNKNOWN) and shown[n].startswith(b" "):
                    shown[n] = shown[n][1:]
                    if self.squeeze and not shown[n]:
                        continue
                break
        # Control pieces end a run of bytes, so they may stand at the ends only.
        if self.controls.isdisjoint(ids[1:-1]):
            try:
                return b"".join(shown).decode()
            except UnicodeDecodeError:
                pass
        out, run = [], b""
        for i, surface in zip(ids, shown, strict=True):
            if self.kinds[i] == BYTE:
                run += surface
            else:
                out += [characters(run), surface.decode()]
                run = b""
        return "".join([*out, characters(run)])


def characters(data: bytes) -> str:
    """UTF-8 as text; each byte that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for width in range(1, 5):
            try:
                out.append(data[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(LOST)
            at += 1
    return "".join(out)


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before a space that follows none."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1] in (" ", SPACE):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    with open(path, "rb") as data:
        found = Model(data.read())
    if found.kind != BPE:
        raise ValueError("only byte-pair models are supported")
    return found


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True) -> DataFrame:
    """One row for each document: its pieces, where they lie in the text, and the text decoded from them.

    ``ids`` are little-endian unsigned 32-bit numbers, between the begin and the end id if ``ends``; ``starts`` and
    ``stops`` little-endian 64-bit UTF-8 offsets into the whole text, one for each id. The bytes of a character that is
    no piece share its place: all but the last are empty. Begin and end id are empty at the borders of the text.
    ``decoded`` is the text of the ids. A null or empty text has only the begin and end id and decodes to "". Rows are
    encoded one by one, so repeated rows and ids and rows without an id stay as they are; other columns are not read. An
    empty table gives no rows. The model's file must be readable at ``path`` on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids", "starts", "stops", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            rows: list[tuple] = []
            first = held = 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                ids, starts, stops = pieces.encode(text)
                if ends:
                    length = int(byte_starts(text)[-1])
                    ids = np.concatenate([[pieces.bos], ids, [pieces.eos]]).astype("<u4")
                    starts, stops = (np.concatenate([[0], a, [length]]).astype("<i8") for a in (starts, stops))
                rows.append((len(ids), ids.tobytes(), starts.tobytes(), stops.tobytes(), pieces.decode(ids)))
                held += len(ids)
                if held > 1 << 20 or i + 1 == batch.num_rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(first, len(rows)), pa.array(columns[0], pa.int64())]
                        + [pa.array(c, pa.binary()) for c in columns[1:4]]
                        + [pa.array(columns[4], pa.string())],
                        names,
                    )
                    first, rows, held = i + 1, [], 0

    shape = f"id {kind}, n_tokens long, ids binary, starts binary, stops binary, decoded string"
    found = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, shape)
    return found.withColumnRenamed("id", id_col)
