"""License scans by patience alignment.

A text's words are aligned with a license template: words that occur once in both are
anchors, the longest increasing run of them (by patience sorting) is kept, and the
gaps between are aligned in the same way, where words that were frequent in the whole
may be unique. Coverage is the share of the template's words that are aligned.

A match of coverage c leaves at most (1 - c) of the template's n places unmatched, so
one of its rarest floor((1 - c) n) + 1 places in the text must be matched, and a match of density d
spans at most n / d words. So only windows of n / d words to both sides of those places are aligned, and a text that
holds too few of the template's words is passed over: every match lies in some window. As
what is unique depends on the range, an alignment of a window may differ from one of the whole
text; the tests compare both over random edits.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")

#: Grants, notices and operative paragraphs of common licenses; those named -notice are one line.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mit-notice": "Released under the MIT License.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "bsd-second-condition": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-third-condition": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. "
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc0-1.0-notice": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first, that increases in the second: patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        if at == len(tops):
            tops.append(y)
            piles.append(i)
        else:
            tops[at], piles[at] = y, i
        back.append(piles[at - 1] if at else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), both increasing."""
    out: list[tuple[int, int]] = []
    open_ranges = [(0, len(text), 0, len(template))]
    while open_ranges:
        a, b, c, d = open_ranges.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once, n = Counter(template[c:d]), Counter(text[a:b])
        place = {w: i for i, w in enumerate(template[c:d], c) if once[w] == 1 and n[w] == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place])
        out += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            if anchors and i + 1 < k and j + 1 < m:
                open_ranges.append((i + 1, k, j + 1, m))
    return sorted(out)


@dataclass(frozen=True)
class Match:
    template: str
    coverage: float
    matched: int
    start: int
    end: int


class Scanner:
    """Templates made ready; ``coverage`` is the least share of a template, ``density`` of the words it spans."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8, density: float = 0.6) -> None:
        self.templates = {k: WORD.findall(t.lower()) for k, t in templates.items()}
        self.coverage, self.density = coverage, density

    def scan(self, text: str) -> list[Match]:
        """Matches by place: where matches overlap, the one with more matched words stays, then the better covered."""
        words = WORD.findall(text.lower())
        seen, counts = set(words), None
        found: list[tuple] = []
        for name, template in self.templates.items():
            n = len(template)
            need = -int(-n * self.coverage // 1)
            if sum(w in seen for w in template) < need:
                continue
            if counts is None:
                counts = Counter(words)
                places: dict[str, list[int]] = {}
                vocabulary = {w for t in self.templates.values() for w in t}
                for i, w in enumerate(words):
                    if w in vocabulary:
                        places.setdefault(w, []).append(i)
            reach = math.ceil(n / self.density)
            rarest = sorted(range(n), key=lambda j: (counts[template[j]], j))[: n - need + 1]
            done = -1
            for at, j in sorted((p, j) for j in rarest for p in places.get(template[j], ())):
                if at < done:
                    continue  # inside a match already taken
                low, high = max(0, at - reach), min(len(words), at + reach + 1)
                pairs = patience(words[low:high], template)
                pairs = self._tightest(pairs, n)
                if len(pairs) >= need:
                    start, end = low + pairs[0][0], low + pairs[-1][0] + 1
                    found.append((-len(pairs), -len(pairs) / n, start, end, name))
                    done = end
        out: list[Match] = []
        for neg, cover, start, end, name in sorted(found):
            if all(end <= m.start or start >= m.end for m in out):
                out.append(Match(name, -cover, -neg, start, end))
        return sorted(out, key=lambda m: m.start)

    def _tightest(self, pairs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
        """Drop stray pairs at either end until the aligned words are dense enough in what they span."""
        while pairs and len(pairs) < self.density * (pairs[-1][0] + 1 - pairs[0][0]):
            left = pairs[1][0] - pairs[0][0] if len(pairs) > 1 else 0
            right = pairs[-1][0] - pairs[-2][0] if len(pairs) > 1 else 0
            pairs = pairs[1:] if left >= right else pairs[:-1]
        return pairs


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, density: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, template, coverage, matched, start_word, end_word (of the text's words, end exclusive).

    Words are runs of letters and digits, lower-cased. Null and empty texts have no match. Texts of any length are read whole, in
    time that grows with their words and with the places of a template's rarest ones. Where matches overlap, the one with more
    matched words stays, then the better covered, the first, and the first template by name. Rows that repeat an id, or have none, are scanned each;
    other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    ready = TEMPLATES if templates is None else templates

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(ready, coverage, density)
        for batch in batches:
            rows = [(i, m) for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in scanner.scan(value.as_py() or "")]
            columns = [[i for i, _ in rows], *[[getattr(m, f) for _, m in rows] for f in ("template", "coverage", "matched", "start", "end")]]
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "template", "coverage", "matched", "start_word", "end_word"])

    schema = "doc_id long, template string, coverage double, matched long, start_word long, end_word long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(work, schema)
