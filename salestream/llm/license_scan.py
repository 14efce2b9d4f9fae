"""License scan by conditional compression.

1. Candidate blocks: a text's stretches of ``AROUND`` characters before and after each cue word (every template
   has them, close enough that a whole license text is one stretch), merged where they overlap, and cut into pieces
   where they get long. Pieces overlap by more than the longest template, so whatever a template may take lies whole in
   one. Whole texts are searched.
2. A block is compressed alone and with each template as raw zstandard dictionary. The bytes that the
   dictionary saves, as a share of the template's own compressed size, rank the templates; those that save
   ``LEAST_SAVING`` or more are looked at closer, the best first.
3. A template is confirmed by exact wording differences: the edit distance in words between it and a stretch of the block
   (versions and numbers are alike). A stretch that takes at most ``MOST_CHANGED`` of the template's words to change,
   and has its name words, is a finding, with the words that differ and the version it states. Of overlapping findings
   the one that has most of its template's words stays, then that with the fewest changes, then the larger saving; so
   a whole license text goes before its first sentence, and lists the words of clauses that were left out or added.

Texts go through Arrow batches, one at a time; nothing is shuffled, so no key can be hot.

Defined results: a null or empty text has no finding. Rows that repeat an id are scanned each. Full ties go to the
template listed first. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.llm.common import in_parts, table

#: Conditions and disclaimer that the BSD licenses share. Fixed wording, like all of the templates.
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

#: License id, words that must stand (its name), and wording; ``{}`` stands for a version or year.
TEMPLATES = (
    ("Apache-2.0", ("apache",), "Licensed under the Apache License, Version {}."),
    ("Apache-2.0", ("apache",), "Licensed under the Apache License, Version {} (the \"License\"); you may not use this file "
                                "except in compliance with the License."),
    ("BSD", ("redistribution",), "Redistribution and use in source and binary forms, with or without modification, are "
                                 "permitted provided that the following conditions are met:"),
    ("CC-BY", ("attribution",), "This work is licensed under a Creative Commons Attribution {} International License."),
    ("CC-BY-NC", ("cc", "by-nc"), "Licensed under CC BY-NC {}."),
    ("CC-BY-SA", ("cc", "by-sa"), "Licensed under CC BY-SA {}."),
    ("CC0", ("waived",), "To the extent possible under law, the author has waived all copyright and related or "
                         "neighboring rights to this work."),
    ("GPL", ("gnu", "general"), "This program is free software: you can redistribute it and/or modify it under the terms of "
                                "the GNU General Public License as published by the Free Software Foundation."),
    ("GPL", ("gnu", "general"), "This work is licensed under the GNU General Public License, version {}."),
    ("ISC", ("permission", "fee"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
                                   "without fee is hereby granted."),
    ("LGPL", ("gnu", "lesser"), "This library is free software; you can redistribute it and/or modify it under the terms of "
                                "the GNU Lesser General Public License."),
    ("MIT", ("permission",), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                             "and associated documentation files."),
    ("MIT", ("mit",), "Released under the MIT License."),
    ("MPL-2.0", ("mozilla",), "This Source Code Form is subject to the terms of the Mozilla Public License, v. {}."),
    ("Proprietary", ("unauthorized",), "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
    # whole texts, and the notices and beginnings of texts too long to stand here
    ("MIT", ("permission",), """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY
OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", ("redistribution",), f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", ("redistribution", "endorse"), f"""{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the
names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission. {_BSD_DISCLAIMER}"""),
    ("ISC", ("permission", "fee"), """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", ("misrepresented",), """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This
notice may not be removed or altered from any source distribution."""),
    ("Unlicense", ("public", "domain"), """This is free and unencumbered software released into the public domain. Anyone is free to
copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""),
    ("Apache-2.0", ("licensor",), """TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.
"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this
document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.
"Legal Entity" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under common
control with that entity."""),
    ("GPL", ("gnu", "general"), """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any
later version."""),
    ("LGPL", ("gnu", "lesser"), """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option)
any later version."""),
    ("AGPL", ("gnu", "affero"), """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
Affero General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option)
any later version."""),
    ("AGPL", ("gnu", "affero"), "This program is free software: you can redistribute it and/or modify it under the terms of "
                                "the GNU Affero General Public License as published by the Free Software Foundation."),
    ("EPL", ("eclipse",), """This program and the accompanying materials are made available under the terms of the Eclipse Public
License {} which is available at"""),
)
#: Without regard to case.
CUES = ("licen[sc]", "redistribut", "permission", "copying", "waived", "warrant", "liab", "misrepresent", "public domain")
AROUND = 300
#: A stretch may be longer than its template by this factor (indents, comment marks, added words).
STRETCHED = 1.5
LEAST_SAVING = 0.15
MOST_CHANGED = 0.2
LEVEL = 3

_CUE = re.compile("|".join(CUES), re.IGNORECASE)
_WORD = re.compile(r"\w+(?:[.\-]\w+)*")
_FREE = re.compile(r"v?\d+(?:\.\d+)*")

FINDING = "license string, template int, start long, length long, saving double, changed int, missing array<string>, " \
          "extra array<string>, version string"


def wording(text: str) -> list[tuple[str, int, int]]:
    """Lower-case words with their place; versions and numbers are one word, ``{}``."""
    return [("{}" if _FREE.fullmatch(m[0].lower()) else m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def blocks(text: str, overlap: int) -> Iterator[tuple[int, str]]:
    """(start, block) of the candidate blocks, in order; long ones in pieces of three times the overlap."""
    low = high = -1
    for cue in _CUE.finditer(text):
        start, stop = max(0, cue.start() - AROUND), min(len(text), cue.end() + AROUND)
        if start > high:
            if high >= 0:
                yield from _pieces(text, low, high, overlap)
            low = start
        high = stop
    if high >= 0:
        yield from _pieces(text, low, high, overlap)


def _pieces(text: str, low: int, high: int, overlap: int) -> Iterator[tuple[int, str]]:
    while high - low > 3 * overlap:
        yield low, text[low:low + 3 * overlap]
        low += 2 * overlap
    yield low, text[low:high]


def ends(template: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Fewest changes (words left out, added or replaced) between the template and a stretch that ends at each word."""
    places = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, dtype=np.int64)
    for w in template:
        after = row + 1
        after[1:] = np.minimum(after[1:], row[:-1] + (words != w))
        row = np.minimum.accumulate(after - places) + places
    return row[1:]


def alignment(template: np.ndarray, words: np.ndarray) -> tuple[int, list[tuple[int | None, int | None]]]:
    """Fewest changes between the template and a stretch that ends with ``words``, and what stands for what.

    Pairs of (place in the template, place in words), in order; a place without counterpart has None. Of stretches
    with equally few changes the longest is taken.
    """
    own, have = template[::-1], words[::-1]
    places = np.arange(len(have) + 1)
    rows = [places]
    for w in own:
        after = rows[-1] + 1
        after[1:] = np.minimum(after[1:], rows[-1][:-1] + (have != w))
        rows.append(np.minimum.accumulate(after - places) + places)
    i, j = len(own), len(have) - int(rows[-1][::-1].argmin())
    changed, pairs = int(rows[-1][j]), []
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (own[i - 1] != have[j - 1]):
            i, j = i - 1, j - 1
            pairs.append((len(own) - 1 - i, len(have) - 1 - j))
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            pairs.append((len(own) - 1 - i, None))
        else:
            j -= 1
            pairs.append((None, len(have) - 1 - j))
    return changed, pairs


class Scanner:
    """Templates made ready: dictionaries, words."""

    def __init__(self, templates: tuple = TEMPLATES):
        self.templates = templates
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        texts = [t.replace("{}", "1").encode() for _, _, t in templates]
        raw = [zstandard.ZstdCompressionDict(t, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for t in texts]
        self.given = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False) for d in raw]
        self.sizes = [len(self.plain.compress(t)) for t in texts]
        placed = [wording(t.replace("{}", "1")) for _, _, t in templates]
        self.words = [[w for w, _, _ in p] for p in placed]
        self.versions = [next((i for i, (_, low, _) in enumerate(p) if low == t.find("{}")), None)
                         for p, (_, _, t) in zip(placed, templates, strict=True)]
        self.overlap = int(STRETCHED * max((len(t) for _, _, t in templates), default=0)) + 2 * AROUND

    def savings(self, block: str) -> list[tuple[float, int]]:
        """(share of its size that a template's dictionary saves, template), the largest first."""
        data = block.encode("utf-8", "replace")
        alone = len(self.plain.compress(data))
        shares = [(round((alone - len(c.compress(data))) / n, 6), i)
                  for i, (c, n) in enumerate(zip(self.given, self.sizes, strict=True))]
        return sorted(shares, key=lambda x: (-x[0], x[1]))

    def confirm(self, block: str, start: int, ranked: list[tuple[float, int]]) -> Iterator[tuple]:
        """Findings of the ranked templates in a block, as rows of ``FINDING``."""
        found = wording(block)
        number: dict[str, int] = {}
        words = np.array([number.setdefault(w, len(number)) for w, _, _ in found], dtype=np.int64)
        for saving, t in ranked:
            license_id, name, _ = self.templates[t]
            if not set(name) <= number.keys():
                continue
            own = np.array([number.get(w, -1) for w in self.words[t]], dtype=np.int64)
            most = int(MOST_CHANGED * len(own))
            changes = ends(own, words)
            free = changes <= most
            after: list[int] = []  # the words after accepted stretches
            for end in sorted(np.flatnonzero(free).tolist(), key=lambda e: (changes[e], e)):
                if not free[end]:
                    continue
                at = bisect_right(after, end)
                first = max(after[at - 1] if at else 0, end + 1 - len(own) - most)
                changed, pairs = alignment(own, words[first:end + 1])
                held = [first + j for _, j in pairs if j is not None]
                if not held or changed > most or not set(name) <= {found[j][0] for j in held}:
                    continue  # only this end is no finding
                free[held[0]:end + 1] = False
                insort(after, end + 1)
                differ = [(i, j) for i, j in pairs if i is None or j is None or own[i] != words[first + j]]
                version = next((found[first + j] for i, j in pairs if i is not None and i == self.versions[t]
                                and j is not None and own[i] == words[first + j]), None)
                low, high = found[held[0]][1], found[end][2]
                yield (license_id, t, start + low, high - low, saving, changed,
                       [self.words[t][i] for i, _ in differ if i is not None],
                       [found[first + j][0] for _, j in differ if j is not None],
                       version and block[version[1]:version[2]])

    def scan(self, text: str | None) -> list[tuple]:
        """The findings of a text, in order of their place; no two overlap."""
        found = []
        for start, block in blocks(text or "", self.overlap):
            ranked = [x for x in self.savings(block) if x[0] >= LEAST_SAVING]
            found += self.confirm(block, start, ranked)
        found.sort(key=lambda f: (len(f[6]) - len(self.words[f[1]]), f[5], -f[4], f[1], f[2]))
        chosen: list[tuple] = []
        taken: list[tuple[int, int]] = []
        for f in found:
            low, high = f[2], f[2] + f[3]
            at = bisect_left(taken, (low, high))
            if (at == len(taken) or taken[at][0] >= high) and (at == 0 or taken[at - 1][1] <= low):
                taken.insert(at, (low, high))
                chosen.append(f)
        return sorted(chosen, key=lambda f: f[2])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row for each finding: doc_id and the columns of ``FINDING`` (start and length in code points)."""
    names = ["doc_id", *(c.split()[0] for c in FINDING.split(", "))]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.string()),
             pa.list_(pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in in_parts(batches):
            rows = [(doc_id, *f) for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for f in scanner.scan(text)]
            columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id long, {FINDING}")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
