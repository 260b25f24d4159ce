"""License scans by winnowed fingerprints and banded alignment.

Templates are cut into shingles of `SHINGLE` words; of each `WINDOW` neighbouring shingles the
one with the smallest hash goes into an inverted index. A document's shingles are looked up
there, and hits of one template that lie within a band of diagonals are one candidate. Each
candidate is aligned with its template in that band (local alignment: an equal word is worth 1,
a replaced, added or missing word costs 1). It counts if the equal words cover `COVERAGE` of the
template, and the words before and after it are aligned again, for further copies; of findings that overlap, the one with more equal words stays.

Templates are whole licenses (`license_texts/`, named by SPDX), the headers that stand in source
files, and apart from both short notices and excerpts, for texts that have no more than that. Long
templates have wider bands. A candidate is aligned only if its band of the document has enough of
the template's words, in any order.

The index holds the templates only and goes to the tasks with the code.

Words are runs of letters and digits in lower case. A null or empty text has no findings.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import ship

ship(__name__)

SHINGLE, WINDOW, BAND, COVERAGE = 3, 2, 6, 0.75
ONE = 2**24
WORD = re.compile(r"[^\W_]+")

_GNU_HEADER = """This {it} is free software; you can redistribute it and/or modify it under the terms of the
GNU {name} as published by the Free Software Foundation; either version {version} of the License, or (at
your option) any later version. This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}
for more details. You should have received a copy of the GNU {name} along with this {it}"""
_GNU_EXCERPT = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
    "as published by the Free Software Foundation"
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"

# Whole licenses, headers, and the customary notices and excerpts of well-known ones.
TEMPLATES = {p.stem: p.read_text("utf-8").strip() for p in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))} | {
    "GPL-2.0-header": _GNU_HEADER.format(it="program", name=_GPL, version="2"),
    "GPL-3.0-header": _GNU_HEADER.format(it="program", name=_GPL, version="3"),
    "LGPL-2.1-header": _GNU_HEADER.format(it="library", name=_LGPL, version="2.1"),
    "LGPL-3.0-header": _GNU_HEADER.format(it="program", name=_LGPL, version="3"),
    "AGPL-3.0-header": _GNU_HEADER.format(it="program", name=_AGPL, version="3"),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License"
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "MIT-excerpt": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "ISC-excerpt": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-excerpt": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "Apache-2.0-excerpt": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-excerpt": _GNU_EXCERPT.format(name=_GPL),
    "LGPL-excerpt": _GNU_EXCERPT.format(name=_LGPL),
    "AGPL-excerpt": _GNU_EXCERPT.format(name=_AGPL),
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


class Index:
    """Template words as numbers from 1 on, and their winnowed shingles by place."""

    def __init__(self, templates: dict[str, str]):
        split = {name: WORD.findall(text.lower()) for name, text in templates.items()}
        self.names = [name for name, words in split.items() if words]
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for words in split.values() for w in words}))}
        self.words = [np.array([self.number[w] for w in split[name]]) for name in self.names]
        self.bands = [max(BAND, w.size // 100) for w in self.words]
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.base = len(self.number) + 1
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            codes = self.shingles(words)
            for i in self.winnowed(codes):
                self.places.setdefault(int(codes[i]), []).append((t, i))
        self.codes = np.array(sorted(self.places), np.int64)

    def shingles(self, numbers: np.ndarray) -> np.ndarray:
        """A code for each shingle; 0 where a word is in no template."""
        n = numbers.size - SHINGLE + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(SHINGLE):
            code = code * self.base + numbers[k : k + n]
            known &= numbers[k : k + n] > 0
        return np.where(known, code, 0)

    @staticmethod
    def winnowed(codes: np.ndarray) -> list[int]:
        """The place of the smallest hash of each window, the last of equal ones."""
        hashes = [xxhash.xxh64_intdigest(str(c).encode()) for c in codes]
        last = max(1, len(hashes) - WINDOW + 1)
        return sorted({min(range(i, min(i + WINDOW, len(hashes))), key=lambda j: (hashes[j], -j)) for i in range(last)}) if hashes else []

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter((self.number.get(w, 0) for w in words), np.int64, len(words))

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first diagonal, last diagonal) of hits within a band of each other."""
        codes = self.shingles(numbers)
        near = np.minimum(np.searchsorted(self.codes, codes), self.codes.size - 1)
        hits = sorted(
            {(t, int(i) - place) for i in np.flatnonzero(self.codes[near] == codes) for t, place in self.places[int(codes[i])]}
        )
        out: list[list[int]] = []
        for t, d in hits:
            if out and out[-1][0] == t and d - out[-1][2] <= self.bands[t] and d - out[-1][1] <= 2 * self.bands[t]:
                out[-1][2] = d
            else:
                out.append([t, d, d])
        return [tuple(c) for c in out]

    def common(self, t: int, numbers: np.ndarray) -> int:
        """How many words of a template are in the text, in any order: no alignment has more equal ones."""
        words, counts = self.bags[t]
        return int(np.minimum(np.bincount(numbers, minlength=self.base)[words], counts).sum())


def aligned(template: np.ndarray, doc: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(equal words, first word, end) of the best local alignment with low <= i - j <= high.

    i counts the document's words, j the template's. A cell's value is its score times `ONE` and its
    number of equal words; the cells of a row stand by their diagonal.
    """
    width, left = high - low + 1, max(0, -low)
    padded = np.full(left + max(doc.size, template.size + high), -1)
    padded[left : left + doc.size] = doc
    none = -(ONE**2)
    before, begun = np.full(width + 1, none), np.zeros(width + 1, np.int64)  # of the row before; one more cell
    steps = np.arange(width) * ONE
    best, first, end = 0, 0, 0
    for j in range(template.size):
        words = padded[j + low + left : j + high + left + 1]
        hit = words == template[j]
        fresh = before[:-1] < ONE
        value = np.where(fresh, 0, before[:-1]) + np.where(hit, ONE + 1, -ONE)
        begin = np.where(fresh, np.arange(width) + (j + low), begun[:-1])
        missing = before[1:] - ONE
        begin = np.where(missing > value, begun[1:], begin)
        value = np.where(words < 0, none, np.maximum(value, missing))
        # added words: the greatest value to the left less the steps from there, the nearest of equal ones
        reach = np.maximum.accumulate(value + steps)
        source = np.maximum.accumulate(np.where(value + steps == reach, np.arange(width), 0))
        before[:-1], begun[:-1] = np.where(words < 0, none, reach - steps), begin[source]
        k = int(np.argmax(np.where(hit, before[:-1], none)))
        if hit[k] and before[k] > best:
            best, first, end = int(before[k]), int(begun[k]), j + low + k + 1
    return best % ONE, first, end


def scan(text: str, index: Index, coverage: float = COVERAGE) -> list[tuple]:
    """(license, start, end, matched, coverage) of a text, in code points, ends exclusive."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    numbers = index.numbers(words)
    found = []
    for t, low, high in index.candidates(numbers):
        template, band = index.words[t], index.bands[t]
        need = coverage * template.size
        parts = [(max(0, low - band), min(numbers.size, high + band + template.size))]
        while parts:
            a, b = parts.pop()
            if b - a < need or index.common(t, numbers[a:b]) < need:
                continue
            matched, begin, end = aligned(template, numbers[a:b], low - band - a, high + band - a)
            if matched and matched >= need:
                found.append((-matched, -matched / template.size, a + begin, a + end, t))
                parts += [(a, a + begin), (a + end, b)]
    kept: list[tuple] = []
    taken = np.zeros(len(words), bool)
    for minus, share, begin, end, t in sorted(found):
        if not taken[begin:end].any():
            taken[begin:end] = True
            kept.append((begin, end, t, -minus, -share))
    if not kept:
        return []
    # lower case can have more code points than the text; the same words stand in the text itself
    spans = [m.span() for m in WORD.finditer(text if len(lowered) == len(text) else lowered)]
    return [
        (index.names[t], spans[begin][0], spans[end - 1][1], matched, share)
        for begin, end, t, matched, share in sorted(kept)
    ]


NAMES = ["license", "start", "end", "matched", "coverage"]


def findings(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row for each license text found: doc_id, license, start, end, matched, coverage."""
    index = Index(TEMPLATES if templates is None else templates)

    def run(batches):
        for b in batches:
            out = [
                (doc_id, *row)
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                for row in (scan(text, index, coverage) if text and index.names else ())
            ]
            if out:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", *NAMES]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, license string, start bigint, end bigint, matched bigint, coverage double"
    )
