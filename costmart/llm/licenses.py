"""Operator 3: license texts in documents, by winnowed fingerprints and banded alignment.

Templates and texts are lower-cased word sequences. Hashes of three consecutive words are winnowed: of
every three in a row the least is kept, so any stretch of five equal words shares a fingerprint. The
templates' fingerprints form an inverted index of bounded size, which goes to the executors with the
code; each text looks its own fingerprints up where it is. Hits near one diagonal are a candidate, as are hits
that follow one another across diagonals, where words are inserted all along the text; and
a banded local alignment of the whole template around that diagonal gives the matched words, their share
of the template (coverage) and the span in the text. Matches that cover at least `COVERAGE` and hold the
template's decisive words (name, version, NC/SA/ND) unbroken are reported, except those inside a longer one.

Defined results: NULL, empty and blank texts have no match. Repeated rows are each reported. A text may
match several templates, and one template several times. Offsets count code points. Extra columns are
ignored. No template gives no match; a template of fewer than five words is refused.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm.frames import table

SHINGLE = 3
WINDOW = 3
BAND = 8
COVERAGE = 0.8
# The index is sent to every executor; more template words than this are refused.
MAX_TEMPLATE_WORDS = 200_000
_TOKEN = re.compile(r"[^\W_]+")
_CACHE = 1 << 18

# Public license texts and notices.
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GRANT_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT-notice": "Released under the MIT License",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": _GRANT_BSD + _WARRANTY_BSD,
    "BSD-3-Clause": (
        _GRANT_BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. " + _WARRANTY_BSD
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU General Public License "
        "along with this program. If not, see https://www.gnu.org/licenses/."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
}

# Siblings of the notices above, which differ in the decisive words only.
for _name, _words in {"CC-BY-SA-4.0": "ShareAlike", "CC-BY-NC-4.0": "NonCommercial", "CC-BY-ND-4.0": "NoDerivatives", "CC-BY-NC-SA-4.0": "NonCommercial-ShareAlike", "CC-BY-NC-ND-4.0": "NonCommercial-NoDerivatives"}.items():
    TEMPLATES[_name] = TEMPLATES["CC-BY-4.0"].replace("Attribution", f"Attribution-{_words}")
TEMPLATES["GPL-2.0"] = TEMPLATES["GPL-3.0"].replace("version 3", "version 2")
TEMPLATES["GPL-2.0-notice"] = TEMPLATES["GPL-3.0-notice"].replace("version 3", "version 2")

# Words that tell a license from its siblings: they stand in every match, side by side, with nothing between.
DECISIVE = {
    "MIT-notice": ("mit license",),
    "Apache-2.0": ("apache license version 2 0",),
    "Apache-2.0-notice": ("apache license version 2 0",),
    "GPL-2.0": ("gnu general public license", "version 2"),
    "GPL-2.0-notice": ("gnu general public license version 2",),
    "GPL-3.0": ("gnu general public license", "version 3"),
    "GPL-3.0-notice": ("gnu general public license version 3",),
    "MPL-2.0": ("mozilla public license v 2 0",),
    "CC-BY-4.0": ("commons attribution 4 0",),
    "CC-BY-SA-4.0": ("commons attribution sharealike 4 0",),
    "CC-BY-NC-4.0": ("commons attribution noncommercial 4 0",),
    "CC-BY-ND-4.0": ("commons attribution noderivatives 4 0",),
    "CC-BY-NC-SA-4.0": ("commons attribution noncommercial sharealike 4 0",),
    "CC-BY-NC-ND-4.0": ("commons attribution noncommercial noderivatives 4 0",),
    "CC-BY-NC-4.0-notice": ("cc by nc 4 0",),
}

_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("license_id", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)
RESULT_SCHEMA = "doc_id long, license_id string, coverage double, matched_words long, start long, end long"


def winnow(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the kept three-word hashes; the rightmost least one of each window."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    for i, factor in enumerate((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), 1):
        h = (h ^ (h >> np.uint64(29))) + words[i : i + n] * np.uint64(factor)
    h ^= h >> np.uint64(32)
    if n <= WINDOW:
        place = np.array([n - 1 - int(np.argmin(h[::-1]))])
        return h[place], place
    frames = np.lib.stride_tricks.sliding_window_view(h, WINDOW)[:, ::-1]
    place = np.unique(np.arange(len(frames)) + WINDOW - 1 - frames.argmin(axis=1))
    return h[place], place


class Scanner:
    """The inverted index of a set of templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.texts = list(templates.values())
        self.words = [_TOKEN.findall(t.lower()) for t in templates.values()]
        for name, words in zip(self.names, self.words):
            if len(words) < SHINGLE + WINDOW - 1:
                raise ValueError(f"template {name} has fewer than {SHINGLE + WINDOW - 1} words")
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words")
        self.known: dict[str, int] = {}
        postings: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for h, at in zip(*(x.tolist() for x in winnow(self.numbers(words)))):
                postings.setdefault(h, []).append((t, at))
        self.postings = postings
        self.hashes = np.array(sorted(postings), np.uint64)

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    raw = words[i].encode()
                    out[i] = known[words[i]] = zlib.crc32(raw) << 32 | zlib.adler32(raw)
        return np.array(out, np.uint64)

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(template, diagonal, template place) of each shared fingerprint, sorted; a diagonal is text place minus template place."""
        if not len(self.hashes):
            return []
        hashes, places = winnow(self.numbers(words))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        return sorted((t, int(places[i]) - p, p) for i in hit.tolist() for t, p in self.postings[int(hashes[i])])

    def candidates(self, hits: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
        """(template, diagonal) of each stretch of hits."""
        last = None
        for t, diagonal, _ in hits:
            # Diagonals within half a band of the last candidate are covered by its alignment.
            if last is None or last[0] != t or diagonal - last[1] > BAND // 2:
                last = (t, diagonal)
                yield last

    def decided(self, t: int, words: list[str]) -> bool:
        """Whether the matched words hold all that is decisive for a built-in template."""
        name = self.names[t]
        if self.texts[t] != TEMPLATES.get(name):
            return True
        flat = f" {' '.join(words)} "
        return all(f" {phrase} " in flat for phrase in DECISIVE.get(name, ()))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, matched words, start, end) of each match in a whole text."""
        lowered = (text or "").lower()
        words = _TOKEN.findall(lowered)
        if len(words) < SHINGLE:
            return []
        found = []
        hits = self.hits(words)
        aligned = [(t, align(self.words[t], words, diagonal)) for t, diagonal in self.candidates(hits)]
        # Inserted words move a license from diagonal to diagonal: its hits are also followed across them.
        for t, own in groupby(hits, key=itemgetter(0)):
            aligned += [(t, align(self.words[t], words, centres)) for centres in chains([h[1:] for h in own], len(self.words[t]))]
        for t, (matched, first, last) in aligned:
            if matched >= COVERAGE * len(self.words[t]) and self.decided(t, words[first : last + 1]):
                found.append((first, last, t, matched))
        if not found:
            return []
        # Longest first, then most words matched; what lies inside a kept match is part of it.
        found.sort(key=lambda m: (m[0] - m[1], -m[3], -m[3] / len(self.words[m[2]]), m[0], m[2]))
        kept: list = []
        for m in found:
            if not any(k[0] <= m[0] and m[1] <= k[1] for k in kept):
                kept.append(m)
        spans = [m.span() for m in _TOKEN.finditer(lowered)]
        back = None
        if len(lowered) != len(text):  # some letters get longer when lower-cased
            back, at = [], 0
            for c in text:
                back.append(at)
                at += len(c.lower())
        out = []
        for first, last, t, matched in sorted(kept):
            start, end = spans[first][0], spans[last][1]
            if back is not None:
                start, end = bisect_left(back, start), bisect_left(back, end)
            out.append((self.names[t], matched / len(self.words[t]), matched, start, end))
        return out


def chains(hits: list[tuple[int, int]], size: int) -> Iterator[list[tuple[int, int]]]:
    """For hits (diagonal, place) of one template, the bands (least, greatest diagonal) per template word of each chain.

    A chain is a run of hits that rise in text and template, scored as an alignment is: equal words gain 2, a
    change of diagonal loses 1 a word. The best chain is taken first, then the best of the hits that are left.
    Chains that stay within one band are left to the plain alignment.
    """
    if not hits or hits[-1][0] - hits[0][0] <= BAND // 2:
        return
    ordered = np.array(sorted((d + p, p) for d, p in hits), np.int64)
    ats, marks = ordered[:, 0], ordered[:, 1]
    score, earlier = np.full(len(ordered), 2 * SHINGLE, np.int64), np.full(len(ordered), -1)
    # A gap longer than twice the template costs more than all its words can gain.
    begins, ends = np.searchsorted(ats, ats - 2 * size), np.searchsorted(ats, ats)
    for i, (low, high) in enumerate(zip(begins.tolist(), ends.tolist())):
        if low < high:
            far, up = ats[i] - ats[low:high], marks[i] - marks[low:high]
            gained = score[low:high] + 2 * np.minimum(np.minimum(far, up), SHINGLE) - np.abs(far - up)
            gained[up <= 0] = -1
            best = int(gained.argmax())
            if gained[best] > score[i]:
                score[i], earlier[i] = gained[best], low + best
    taken = np.zeros(len(ordered), bool)
    for i in np.argsort(-score, kind="stable").tolist():
        chain = []
        while i >= 0 and not taken[i]:
            taken[i] = True
            chain.append((int(ats[i]), int(marks[i])))
            i = int(earlier[i])
        if not chain:
            continue
        chain.reverse()
        diagonals = [at - place for at, place in chain]
        if max(diagonals) - min(diagonals) <= BAND // 2:
            continue
        bands, nth = [], 0
        for i in range(size):
            while nth + 1 < len(chain) and chain[nth + 1][1] <= i:
                nth += 1
            near = diagonals[max(0, nth - 1) : nth + 2]
            bands.append((min(near), max(near)))
        yield bands


def align(template: list[str], words: list[str], diagonal: int | list[tuple[int, int]]) -> tuple[int, int, int]:
    """(equal words, first and last word of the span) of the best local alignment within the band.

    Equal words gain 2, others and gaps lose 1. A cell holds score, equal words and where it began. The band
    lies around one diagonal, or around the least and greatest diagonal given for each template word.
    """
    if not isinstance(diagonal, int):
        return _align_moving(template, words, diagonal)
    width = 2 * BAND + 1
    none = (0, 0, -1)
    row, best = [none] * width, (0, 0, -1, -1)
    for i, w in enumerate(template):
        left, new = none, []
        for b in range(width):
            j = i + diagonal + b - BAND
            if not 0 <= j < len(words):
                cell = none
            else:
                s, m, begin = row[b]
                cell = (s + 2, m + 1, begin if s else j) if w == words[j] else (s - 1, m, begin)
                up = row[b + 1] if b + 1 < width else none
                for s, m, begin in (up, left):
                    if s - 1 > cell[0]:
                        cell = (s - 1, m, begin)
                if cell[0] <= 0:
                    cell = none
                elif cell[0] > best[0]:
                    best = (*cell, j)
            new.append(cell)
            left = cell
        row = new
    return best[1], best[2], best[3]


def _align_moving(template: list[str], words: list[str], bands: list[tuple[int, int]]) -> tuple[int, int, int]:
    none = (0, 0, -1)
    row: dict[int, tuple[int, int, int]] = {}
    best = (0, 0, -1, -1)
    for i, (w, (low, high)) in enumerate(zip(template, bands)):
        left, new = none, {}
        for j in range(max(0, i + low - BAND), min(len(words), i + high + BAND + 1)):
            s, m, begin = row.get(j - 1, none)
            cell = (s + 2, m + 1, begin if s else j) if w == words[j] else (s - 1, m, begin)
            for s, m, begin in (row.get(j, none), left):
                if s - 1 > cell[0]:
                    cell = (s - 1, m, begin)
            if cell[0] <= 0:
                cell = none
            else:
                new[j] = cell
                if cell[0] > best[0]:
                    best = (*cell, j)
            left = cell
        row = new
    return best[1], best[2], best[3]


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per match: doc_id, license_id, coverage, matched_words, start, end."""
    chosen = TEMPLATES if templates is None else templates
    Scanner(chosen)  # refuses bad templates before a job starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            rows = [(d, *m) for d, text in zip(batch.column(0).to_pylist(), batch.column(1)) for m in scanner.scan(text.as_py())]
            columns = zip(*rows) if rows else [[]] * len(_RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT_SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))
