"""Licence notices and texts found by patience alignment with templates."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import map_rows, prepare, table

THRESHOLD = 0.8
#: A template's words stand within this many times its length, and two more.
STRETCH = 1.5

#: Wording of well-known public notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("All-rights-reserved", "All rights reserved."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
#: Words of a licence's name; a notice has those of them in place that its template has.
NAMES = {"Apache-2.0": "apache", "MIT": "mit", "GPL-3.0": "gnu", "GPL-2.0": "gnu", "LGPL-3.0": "lesser", "MPL-2.0": "mozilla", "CC-BY-4.0": "cc creative", "CC-BY-SA-4.0": "cc sa", "CC-BY-NC-4.0": "cc nc", "CC-BY-ND-4.0": "cc nd", "CC-BY-NC-SA-4.0": "cc nc sa", "CC-BY-NC-ND-4.0": "cc nc nd", "All-rights-reserved": "reserved"}
Notice = tuple[int, int, str, float]  # start, end, licence, coverage


def rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Pairs of places of equal words, rising on both sides.

    Equal heads and tails are paired, then words that are once in each side
    anchor the rest: a longest rising subsequence of them is kept, and the gaps
    between are aligned alike.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a[w] == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if a[i] in place]
        kept = [anchors[i] for i in rising([y for _, y in anchors])]
        if not kept:
            continue
        last = (a0 - 1, b0 - 1)
        for x, y in [*kept, (a1, b1)]:
            todo.append((last[0] + 1, x, last[1] + 1, y))
            last = (x, y)
        out += kept
    return sorted(out)


@dataclass
class Template:
    """A template's words as numbers of the vocabulary, and what a stretch of text needs to be aligned with it."""

    name: str
    words: list[int]
    need: int  # words in place
    window: int  # words of text that they may stand within
    named: frozenset[int]  # places of the words of the licence's name
    times: np.ndarray  # of each word of the vocabulary in the template
    first: np.ndarray  # whether a word may be the first in place: it is among the template's first but for those that may be missing


@cache
def compiled(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> tuple[np.ndarray, list[Template]]:
    """The vocabulary of all templates, as rising hashes, and the templates; words are those of `textkit.words`."""
    texts = [t for _, t in templates] + list(NAMES.values())
    w = textkit.words(texts)
    vocabulary, number = np.unique(w.hash, return_inverse=True)
    own = [number[a:b].tolist() for a, b in zip(w.bounds, w.bounds[1:], strict=False)]
    names = dict(zip(NAMES, own[len(templates):], strict=True))
    out = []
    for (name, _), words in zip(templates, own, strict=False):
        if words:
            need = int(np.ceil(threshold * len(words) - 1e-9))
            first = np.zeros(len(vocabulary) + 1, bool)
            first[words[:len(words) - need + 1]] = True
            named = frozenset(words.index(x) for x in names.get(name, ()) if x in words)
            out.append(Template(name, words, need, int(STRETCH * len(words)) + 2, named, np.bincount(words, minlength=len(vocabulary) + 1), first))
    return vocabulary, out


def _aligned(code: np.ndarray, start: int, end: int, t: Template) -> tuple[int, int, int] | None:
    """Words in place of a template in a stretch of text: from, to (exclusive) and how many; none if too few."""
    have = np.bincount(code[start:end], minlength=len(t.times))
    if int(np.minimum(have, t.times).sum()) < t.need:
        return None
    pairs = patience(code[start:end].tolist(), t.words)
    if len(pairs) < t.need or not t.named <= {y for _, y in pairs}:
        return None
    return start + pairs[0][0], start + pairs[-1][0] + 1, len(pairs)


def _found(code: np.ndarray, t: Template) -> list[tuple[int, int, int]]:
    """Where a template stands in a text, from left to right, each time with the most words in place.

    Stretches are looked at from each word on that may be the template's first
    in place and that has enough of its words after it.
    """
    known = np.append(0, np.cumsum(t.times[code] > 0))
    at = np.flatnonzero(t.first[code])
    ends = np.minimum(at + t.window, len(code))
    at = at[known[ends] - known[at] >= t.need].tolist()
    out: list[tuple[int, int, int]] = []
    k = 0
    while k < len(at):
        best = _aligned(code, at[k], min(len(code), at[k] + t.window), t)
        k += 1
        while best and k < len(at) and at[k] < best[1]:
            other = _aligned(code, at[k], min(len(code), at[k] + t.window), t)
            best = other if other and other[2] > best[2] else best
            k += 1
        if best:
            out.append(best)
    return out


def notices_of(texts: list[str], templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> list[list[Notice]]:
    """Notices of each text, in its order, apart from each other: of those that overlap the one with the most words in place stays."""
    vocabulary, compiled_templates = compiled(templates, threshold)
    w = textkit.words(texts)
    at = np.minimum(np.searchsorted(vocabulary, w.hash), len(vocabulary) - 1)
    codes = np.where(vocabulary[at] == w.hash, at, len(vocabulary))
    out = []
    for i, (a, b) in enumerate(zip(w.bounds.tolist(), w.bounds.tolist()[1:], strict=False)):
        code = codes[a:b]
        found = [(-n, -n / len(t.words), x, y, t.name) for t in compiled_templates for x, y, n in _found(code, t)] if (code < len(vocabulary)).any() else []
        taken: list[tuple[int, int]] = []
        kept = []
        for _, coverage, x, y, name in sorted(found):
            place = bisect_left(taken, (x, x))
            if (place == 0 or taken[place - 1][1] <= x) and (place == len(taken) or taken[place][0] >= y):
                insort(taken, (x, y))
                kept.append((int(w.start[a + x]), int(w.end[a + y - 1]), name, round(-coverage, 4)))
        out.append(sorted(kept))
    return out


def notices(text: str, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> list[Notice]:
    return notices_of([text], templates, threshold)[0]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [f for _, run in textkit.chunks(pdf["text"]) for f in notices_of(run)]
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"],
            "n_notices": [len(f) for f in found],
            "licenses": [",".join(sorted({n for _, _, n, _ in f})) for f in found],
            "coverage": [max((c for *_, c in f), default=0.0) for f in found],
            "notices": [",".join(f"{n}:{a}:{b}" for a, b, n, _ in f) for f in found],
        })


def license_notices(docs: DataFrame) -> DataFrame:
    """Licence notices of every document: ``doc_id``, ``n_notices``, ``licenses``, ``coverage``, ``notices``.

    Takes ``doc_id`` and ``text``; other columns are ignored. ``licenses`` has the
    distinct names, sorted and joined by commas, ``coverage`` the largest share
    of a template's words in place (0 without a notice), ``notices`` each
    ``name:start:end`` in code points. Every text is aligned, by `patience`, with
    each template wherever it has enough of the template's words near each
    other to reach the threshold; words are lower-cased runs of letters and
    digits, an ideograph is one. The licence's own name must be in place where
    the template has it. Repeated notices are found each; of notices that
    overlap the one with the most words in place counts. A null or empty text
    has none. Repeated rows are each scanned; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, _scan, "doc_id long, n_notices long, licenses string, coverage double, notices string")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(table(spark, sf_dir, "documents"))
