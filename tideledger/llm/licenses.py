"""License scans by patience alignment of texts with license templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from tideledger.llm.common import texts

_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
    "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more "
    "details. You should have received a copy of the GNU {0}General Public License along with this program."
)
_CC = "This work is licensed under a Creative Commons {} International License."
#: Short notices and standard headers of public licenses, by SPDX name; whole texts are in ``license_texts``.
#: Callers may pass their own.
TEMPLATES = {
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _GNU.format("", "3")],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _GNU.format("", "2")],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", _GNU.format("Affero ", "3")],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _GNU.format("Lesser ", "3")],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", _GNU.format("Lesser ", "2.1")],
    "LGPL-2.0": ["This work is licensed under the GNU Library General Public License, version 2.", _GNU.format("Library ", "2")],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", _CC.format("Attribution-NonCommercial 4.0")],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", _CC.format("Attribution 4.0")],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", _CC.format("Attribution-ShareAlike 4.0")],
    "CC-BY-SA-3.0": ["Licensed under CC BY-SA 3.0.", _CC.format("Attribution-ShareAlike 3.0")],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", _CC.format("Attribution-NoDerivatives 4.0")],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", _CC.format("Attribution-NonCommercial-ShareAlike 4.0")],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", _CC.format("Attribution-NonCommercial-NoDerivatives 4.0")],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)"
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    ],
}
#: whole texts, a file for each SPDX name; only the driver reads them
TEXTS = Path(__file__).with_name("license_texts")
#: share of a template's words that must be aligned
COVERAGE = 0.8
_WORD = re.compile(r"\w+")


def known_templates() -> dict[str, list[str]]:
    """Notices, headers and whole texts of the known licenses by SPDX name."""
    found = {name: list(own) for name, own in TEMPLATES.items()}
    for path in sorted(TEXTS.glob("*.txt")):
        found.setdefault(path.stem, []).append(path.read_text(encoding="utf-8"))
    return found


def words(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with their place in code points."""
    return [(found.group().lower(), found.start(), found.end()) for found in _WORD.finditer(text)]


def rising(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence: each place goes on the leftmost pile whose top isn't smaller."""
    tops: list[int] = []
    piled: list[int] = []
    before: list[int | None] = []
    for index, place in enumerate(places):
        pile = bisect_left(tops, place)
        before.append(piled[pile - 1] if pile else None)
        if pile == len(tops):
            tops.append(place)
            piled.append(index)
        else:
            tops[pile], piled[pile] = place, index
    chain, index = [], piled[-1] if piled else None
    while index is not None:
        chain.append(index)
        index = before[index]
    return chain[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal words, rising on both sides.

    Words that occur once on either side are anchors; a longest increasing subsequence of them is kept; the gaps between are
    aligned the same way. Equal words at a gap's two ends are taken first.
    """
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        low, high, first, last = gaps.pop()
        while low < high and first < last and text[low] == template[first]:
            pairs.append((low, first))
            low, first = low + 1, first + 1
        while low < high and first < last and text[high - 1] == template[last - 1]:
            high, last = high - 1, last - 1
            pairs.append((high, last))
        if low == high or first == last:
            continue
        here, there = Counter(text[low:high]), Counter(template[first:last])
        once = {word: place for place, word in enumerate(template[first:last], first) if there[word] == 1 and here[word] == 1}
        anchors = [(place, once[word]) for place, word in enumerate(text[low:high], low) if word in once]
        chain = [anchors[index] for index in rising([there_at for _, there_at in anchors])]
        if not chain:
            continue
        pairs.extend(chain)
        for (left, under), (right, over) in zip([(low - 1, first - 1), *chain], [*chain, (high, last)], strict=True):
            gaps.append((left + 1, right, under + 1, over))
    return sorted(pairs)


def windows(text: list[str], template: list[str]) -> Iterator[tuple[int, int]]:
    """Parts of ``text`` that could hold ``template``: runs of its words without a gap longer than a quarter of it."""
    inside = set(template)
    slack = max(2, len(template) // 4)
    places = [place for place, word in enumerate(text) if word in inside]
    low = 0
    for index in range(1, len(places) + 1):
        if index == len(places) or places[index] - places[index - 1] > slack:
            if len({text[place] for place in places[low:index]}) >= COVERAGE * len(inside):
                yield places[low], places[index - 1] + 1
            low = index


def found_spans(text: list[str], template: list[str]) -> Iterator[tuple[int, int, int]]:
    """First word, last word and number of aligned words of every place where ``text`` holds ``template``.

    A run with several copies has no unique words, so a run is first cut before every later occurrence of the template's
    rarest word in it, half-way to the one before.
    """
    for low, high in windows(text, template):
        own = text[low:high]
        counts, there = Counter(own), Counter(template)
        rarest = min(template, key=lambda word: (counts[word] or len(own), there[word]))
        marks = [low + place for place, word in enumerate(own) if word == rarest]
        lead = template.index(rarest)
        cuts = [low, *(max(low, mark - lead - max(1, len(template) // 8)) for mark in marks[1:]), high]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            pairs = align(text[begin:end], template)
            if pairs and len(pairs) >= COVERAGE * len(template):
                yield begin + pairs[0][0], begin + pairs[-1][0], len(pairs)


class Template:
    """A template's words, and some of them without which a text can't hold it."""

    def __init__(self, name: str, body: list[str]):
        self.name, self.body, self.own = name, body, set(body)
        needed = math.ceil(COVERAGE * len(self.own) - 1e-9)
        # a text that has enough of the words has one of any so many; long words are in few texts
        self.probe = set(sorted(self.own, key=lambda word: (-len(word), word))[: len(self.own) - needed + 1])

    def fits(self, there: set[str]) -> bool:
        return not self.probe.isdisjoint(there) and len(self.own & there) >= COVERAGE * len(self.own)


def prepared(templates: dict[str, list[str]]) -> list[Template]:
    """Templates as words; those without any, and repeats of a name's, aren't any."""
    return [Template(name, list(body)) for name, own in templates.items() for body in {tuple(w for w, _, _ in words(x)) for x in own} if body]


def scan(text: str, templates: list[Template]) -> list[tuple[int, int, str, float]]:
    """Start, end (code points, exclusive), name and coverage of license notices.

    Of overlapping ones the one with the most aligned words stays, less the words of either side that aren't aligned.
    """
    own = words(text)
    plain = [word for word, _, _ in own]
    there = set(plain)
    found = []
    for template in templates:
        if template.fits(there):
            size = len(template.body)
            for first, last, aligned in found_spans(plain, template.body):
                worth = aligned - (size - aligned) - (last + 1 - first - aligned)
                found.append((worth, size, own[first][1], own[last][2], template.name, aligned / size))
    kept: list[tuple[int, int, str, float]] = []
    for _, _, start, end, name, share in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[4])):
        if all(end <= other[0] or other[1] <= start for other in kept):
            kept.append((start, end, name, share))
    return sorted(kept)


def _scan(templates: list[Template]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text.as_py(), templates) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(row) for row in rows], pa.int64()),
                    pa.array([",".join(sorted({name for _, _, name, _ in row})) for row in rows], pa.string()),
                    pa.array([max((share for *_, share in row), default=0.0) for row in rows], pa.float64()),
                    pa.array([",".join(f"{name}:{start}:{end}" for start, end, name, _ in row) for row in rows], pa.string()),
                ],
                names=["doc_id", "n_found", "licenses", "coverage", "spans"],
            )

    return run


def license_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """License notices in every row of ``docs`` (``doc_id``, ``text``, any others).

    Returns ``doc_id``, ``n_found``, ``licenses`` (sorted names, comma-joined, empty if none), ``coverage`` (the best share of
    a template's words aligned in order, 0 if none) and ``spans`` (``name:start:end`` in code points). A notice counts from
    ``COVERAGE`` on. Null and empty texts hold none; whole texts are read; repeated rows and null ids stay; no rows give none.
    One narrow pass; the templates travel with the task.
    """
    bodies = prepared(templates or known_templates())
    schema = "doc_id long, n_found long, licenses string, coverage double, spans string"
    return texts(docs).mapInArrow(_scan(bodies), schema)
