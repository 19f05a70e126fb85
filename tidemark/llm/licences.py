"""Licence scans by matching statistics of a generalised suffix automaton over licence templates.

The automaton holds every run of words of every template. A document is streamed through it word by word; long
maximal matches are chained in the order of a template, and a chain that covers enough of it is a licence span.
Beside this, places of fixed phrases are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import quoted, text_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of well-known public licences.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "Copyright. All rights reserved. No part of this work may be reproduced without permission."),
]

#: Words of a maximal match that counts.
MIN_MATCH = 4
#: Words that may be missing or added between two matches of a chain.
MAX_GAP = 8
#: Share of a template that a chain must cover.
MIN_COVERAGE = 0.75

#: Digits, lower-case letters and bytes beyond ASCII stand for themselves, capitals for their lower case.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


@dataclass
class Automaton:
    """A generalised suffix automaton; of each state the places (template, last word) where it ends."""

    ids: dict[bytes, int] = field(default_factory=dict)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])

    def _state(self, size: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.ends.append([])
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the strings of ``q`` that are one word longer than ``p``."""
        if self.size[p] + 1 == self.size[q]:
            return q
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        state = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, self.next[p][word], word)
        return state

    def add(self, number: int, template: list[bytes]) -> None:
        last = 0
        for word in template:
            last = self._extend(last, self.ids.setdefault(word, len(self.ids)))

    def place(self, number: int, template: list[bytes]) -> None:
        """Note where the prefixes of a template end, for every state on their suffix paths."""
        state = 0
        for i, word in enumerate(template):
            state = self.next[state][self.ids[word]]
            p = state
            while p > 0:
                self.ends[p].append((number, i))
                p = self.link[p]

    def matches(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, length, state) of the maximal matches of ``MIN_MATCH`` words or more."""
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        found = []
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start < MIN_MATCH:
                continue
            state = length = 0
            for i in range(start, end):
                word = int(ids[i])
                before = (i - length, length, state)
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.size[state]
                if word in self.next[state]:
                    state = self.next[state][word]
                    length += 1
                if length <= before[1] and before[1] >= MIN_MATCH:
                    found.append(before)
            if length >= MIN_MATCH:
                found.append((end - length, length, state))
        return found


@lru_cache(maxsize=2)
def automaton(templates: tuple[tuple[str, str], ...]) -> tuple[Automaton, list[tuple[str, int]]]:
    built = Automaton()
    parsed = [words(text) for _, text in templates]
    for number, template in enumerate(parsed):
        built.add(number, template)
    for number, template in enumerate(parsed):
        built.place(number, template)
    return built, [(label, len(p)) for (label, _), p in zip(templates, parsed, strict=True)]


def spans(found: list[bytes], templates: tuple[tuple[str, str], ...]) -> list[tuple[str, int, int, float]]:
    """(label, first word, end, coverage) of the chains that cover enough of a template.

    Matches of one template are chained while both the document and the template go on, with at most ``MAX_GAP``
    words between them; a match that fits no open chain starts one.
    """
    auto, sizes = automaton(templates)
    ids = np.fromiter(map(auto.ids.get, found, repeat(-1)), np.int64, len(found))
    open_: dict[int, list[list[int]]] = {}
    done: list[tuple[str, int, int, float]] = []

    def close(number: int, chain: list[int]) -> None:
        label, size = sizes[number]
        coverage = chain[3] / size
        if coverage >= MIN_COVERAGE:
            done.append((label, chain[0], chain[1], min(1.0, coverage)))

    for start, length, state in auto.matches(ids):
        for number, last in auto.ends[state]:
            first = last - length + 1
            chains = open_.setdefault(number, [])
            for chain in [c for c in chains if c[1] + MAX_GAP < start]:
                close(number, chain)
                chains.remove(chain)
            best = None
            for chain in chains:
                # A match may begin inside the last one, where the two overlap in document and template.
                over = max(0, chain[1] - start, chain[2] - first)
                if over < length and first + over - chain[2] <= MAX_GAP and (best is None or chain[3] > best[0][3]):
                    best = (chain, over)
            if best is None:
                chains.append([start, start + length, last + 1, length])
            else:
                chain, over = best
                chain[1], chain[2], chain[3] = start + length, last + 1, chain[3] + length - over
    for number, chains in open_.items():
        for chain in chains:
            close(number, chain)
    return sorted(set(done), key=lambda s: (s[1], s[2], s[0]))


def phrase_places(found: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after the other."""
    line = b" " + b" ".join(found) + b" "
    places = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at, counted, word = line.find(wanted), 0, 0
        while at >= 0:
            word += line.count(b" ", counted, at)
            counted = at
            places.append((word, label))
            at = line.find(wanted, at + 1)
    return sorted(places)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per document: places of phrases, licence spans, labels of both and the best coverage as ``score``.

    Whole texts are read; a null text is an empty one: no words, no places, empty labels, score 0. Rows that repeat an
    id give a row each. ``first_word`` and ``last_word`` are the smallest and greatest start of a phrase, else null.
    ``score`` is the greatest share of a template that a span covers, and 1 where a phrase stands.
    """
    phrases = PHRASES if phrases is None else phrases
    held = tuple(TEMPLATES if templates is None else templates)
    kind = docs.schema[id_col].dataType.simpleString()
    span_type = pa.list_(
        pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("coverage", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = words(text.as_py())
                places = phrase_places(found, phrases)
                covered = spans(found, held)
                base = sorted({label for _, label in places})
                every = sorted({*base, *(s[0] for s in covered)})
                rows.append(
                    (
                        len(found),
                        len(places),
                        places[0][0] if places else None,
                        places[-1][0] if places else None,
                        ",".join(base),
                        ",".join(every),
                        1.0 if places else max((s[3] for s in covered), default=0.0),
                        [dict(zip(("label", "first_word", "end_word", "coverage"), s, strict=True)) for s in covered],
                    )
                )
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span_type]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *names])

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    out = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        run,
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first_word:bigint,end_word:bigint,coverage:double>>",
    )
    return out.withColumnRenamed("id", id_col)
