"""Plain versions of the operators, for a few documents."""

from __future__ import annotations

import hashlib
import re
import zlib


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def exact(rows):
    """doc_id -> (keep_id, group_size, kept, digest); ids are unique."""
    groups: dict[str, list[int]] = {}
    marks = {key: sha(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()) for key, text in rows}
    for key, _ in rows:
        groups.setdefault(marks[key], []).append(key)
    return {k: (min(groups[m]), len(groups[m]), k == min(groups[m]), m) for k, m in marks.items()}


def simhash(text: str | None, shingle: int = 3) -> int:
    from xxhash import xxh64_intdigest

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    runs = [words] if len(words) < shingle else [words[i : i + shingle] for i in range(len(words) - shingle + 1)]
    hashes = [xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows, max_bits: int = 3):
    """doc_id -> (fingerprint, component)."""
    marks = [(key, simhash(text)) for key, text in rows]
    root = {key: key for key, _ in marks}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(marks):
        for b, y in marks[:i]:
            if (x ^ y).bit_count() <= max_bits:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {key: (f"{mark:016x}", find(key)) for key, mark in marks}


def cut(rows, length: int = 100):
    """doc_id -> (bytes, removed, spans, digest of what stays); rows in order of id."""
    seen = set()
    out = {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            stretch = hashlib.md5(data[i : i + length]).digest()
            if stretch in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(stretch)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[key] = (len(data), sum(gone), spans, sha(kept))
    return out


def phrases(text: str | None):
    """(words, places, first, last, labels)."""
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    starts = [i for i, _ in found]
    return (
        len(words),
        len(found),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in found})),
    )


def held_out(key: int) -> bool:
    return zlib.crc32(str(key).encode()) % 5 == 0
