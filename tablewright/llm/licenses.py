"""License statements inside documents: which template, how much of it, and where.

Method: the word trigrams of every template are winnowed to fingerprints in an inverted index. A document's
trigrams are looked up in it; hits on nearby diagonals make a candidate, and a banded alignment of the
template with that stretch of the document gives the words that match, the coverage and the span.

Words are runs of ASCII letters and digits and of non-ASCII bytes, with A-Z as a-z, so punctuation and line
breaks do not matter. Winnowing finds every stretch of GRAM + WINDOW - 1 words that a document shares with a
template (shorter templates: the whole of it).

Defined cases: a null or empty text has no matches; a template of fewer than GRAM words is refused; every
separate occurrence gives a row; a match that overlaps one of higher coverage and no
fewer words is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewright.llm.common import model, pieces, ship
from tablewright.llm.words import Words, letters, mixed

GRAM, WINDOW = 3, 2
LEAST_PERCENT = 80
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LETTERS = letters(7, fold=True)

# Public license texts: short statements, and the notices and grants of common licenses.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
}


def grams(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - GRAM + 1)
    out = np.full(n, np.uint64(GRAM))
    for i in range(GRAM):
        out = mixed(out + words[i : i + n])
    return out


def winnowed(fingerprints: np.ndarray) -> list[int]:
    """Places of the least fingerprint of every window, the rightmost of equals."""
    if len(fingerprints) <= WINDOW:
        return [len(fingerprints) - 1 - int(fingerprints[::-1].argmin())]
    out: list[int] = []
    for i in range(len(fingerprints) - WINDOW + 1):
        at = i + WINDOW - 1 - int(fingerprints[i : i + WINDOW][::-1].argmin())
        if not out or out[-1] != at:
            out.append(at)
    return out


def banded(pattern: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Local alignment (match 2, mismatch or gap -1) of words, inside diagonals low..high (text place minus
    pattern place): matched words, and the first and last text word that they span (-1 without a match)."""
    best = (0, 0, -1, -1)
    row: dict[int, tuple[int, int, int]] = {}
    words = text.tolist()
    for i, p in enumerate(pattern.tolist()):
        new: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + low), min(len(words), i + high + 1)):
            score, matched, first = row.get(j - 1, (0, 0, -1))
            if p == words[j]:
                cell = (score + 2, matched + 1, first if score > 0 and first >= 0 else j)
            else:
                cell = (score - 1, matched, first)
            for other in (row.get(j), new.get(j - 1)):
                if other is not None and other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, other[1], other[2])
            if cell[0] > 0:
                new[j] = cell
                if (cell[0], cell[1]) > best[:2]:
                    best = (cell[0], cell[1], cell[2], j)
        row = new
    return best[1], best[2], best[3]


def better(matches: list[tuple]) -> list[tuple]:
    """Leave out matches that overlap one with a higher coverage and as many words: near relatives of it."""
    kept: list[tuple] = []
    for m in sorted(matches, key=lambda m: -m[2] / m[3]):
        if not any(k[4] < m[5] and m[4] < k[5] and m[2] / m[3] < k[2] / k[3] and m[2] <= k[2] for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: (m[4], m[1]))


class Scanner:
    def __init__(self, templates: dict[str, str], least_percent: int):
        self.names = list(templates)
        self.least = least_percent
        found = Words(pa.array(list(templates.values()), pa.string()), SEPARATORS)
        hashes, places = found.hashes(LETTERS), found.places
        self.words = [hashes[a:b] for a, b in zip(places, places[1:], strict=False)]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            if len(words) < GRAM:
                raise ValueError(f"template {self.names[t]} has fewer than {GRAM} words")
            own = grams(words)
            for at in winnowed(own):
                self.index.setdefault(int(own[at]), []).append((t, at))
        self.fingerprints = np.array(sorted(self.index), np.uint64)

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, str, int, int, int, int]]:
        """(row, template, matched words, template words, start, end) with offsets in code points."""
        found = Words(texts, SEPARATORS)
        words = found.hashes(LETTERS)
        keys = grams(words)
        if not len(keys) or not len(self.fingerprints):
            return
        at = np.minimum(np.searchsorted(self.fingerprints, keys), len(self.fingerprints) - 1)
        hits = np.flatnonzero(self.fingerprints[at] == keys)
        rows = np.searchsorted(found.places, hits, "right") - 1
        diagonals: dict[tuple[int, int], list[int]] = {}
        for hit, row in zip(hits.tolist(), rows.tolist(), strict=True):
            if hit + GRAM <= found.places[row + 1]:
                for t, place in self.index[int(keys[hit])]:
                    diagonals.setdefault((row, t), []).append(hit - place)
        by_row: dict[int, list[tuple]] = {}
        for (row, t), own in sorted(diagonals.items()):
            by_row.setdefault(row, []).extend(self._aligned(found, words, row, t, sorted(own)))
        for row in sorted(by_row):
            yield from better(by_row[row])

    def _aligned(self, found: Words, words: np.ndarray, row: int, t: int, own: list[int]) -> Iterator[tuple]:
        pattern = self.words[t]
        first, last = int(found.places[row]), int(found.places[row + 1])
        band = max(1, len(pattern) // 8)
        groups = [[own[0], own[0]]]
        for d in own[1:]:
            if d - groups[-1][1] <= band:
                groups[-1][1] = d
            else:
                groups.append([d, d])
        done = -1
        for low, high in groups:
            a, b = max(first, low - band), min(last, high + band + len(pattern))
            matched, start, end = banded(pattern, words[a:b], low - band - a, high + band - a)
            if 100 * matched < self.least * len(pattern) or a + start <= done:
                continue
            done = a + end
            head = int(found.text_starts[row])
            place = len(found.raw[head : found.starts[a + start]].tobytes().decode(errors="replace"))
            length = len(found.raw[found.starts[a + start] : found.stops[a + end]].tobytes().decode(errors="replace"))
            yield row, self.names[t], matched, len(pattern), place, place + length


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: dict[str, str] | None = None,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """(key, license, matched_words, template_words, coverage_percent, start, end) of every occurrence that
    matches at least ``least_percent`` of a template's words."""
    ship(df.sparkSession)
    chosen = dict(TEMPLATES if templates is None else templates)
    if sum(map(len, chosen.values())) > 16 << 20:
        raise ValueError("templates beyond 16 MB: scan in several calls")
    mark = repr((sorted(chosen.items()), least_percent)).encode()
    names = "license matched_words template_words coverage_percent start end".split()
    kinds = [T.StringType(), *[T.LongType()] * 5]
    schema = T.StructType([df.schema[key], *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])
    types = [pa.string(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model("licenses", mark, lambda: Scanner(chosen, least_percent))
        for piece in pieces(batches, text):
            rows = list(scanner.scan(piece.column(1)))
            if rows:
                at, name, matched, total, start, end = zip(*rows, strict=True)
                percent = [100 * m // n for m, n in zip(matched, total, strict=True)]
                columns = [pa.array(c, k) for c, k in zip((name, matched, total, percent, start, end), types, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(at)), *columns], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)
