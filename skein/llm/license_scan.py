"""Licence texts found in documents.

Templates are cut into runs of GRAM words; the least hashes of neighbouring runs (winnowing) are their fingerprints, kept in an
inverted index. A document's runs are looked up in it, and the hits of one template on one diagonal are a candidate place. There
the template is aligned with the document to both sides of the hit, in a band of as many words as may be missing, and the
share of its words that is matched in order is reported, with the span, if it reaches the threshold. Places are taken in
order of their matched words, less the missing ones; words that are taken are not matched again, so copies that follow one another are all found.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.words import ALNUM, blocks, window_hashes

GRAM = 3
WINNOW = 4
COVERAGE = 0.75

# Licence texts, and the notices and headers that files carry, in their published wording, without names and years.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    "MIT/notice": "Released under the MIT License.",
    "MIT/text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause/text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
        OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause/text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
        OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD/notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC/text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
        IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSL-1.0/notice": "Distributed under the Boost Software License, Version 1.0.",
    "GPL-2.0/header": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "LGPL/header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free
        Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "LGPL/notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL-3.0/header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free
        Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.
        You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "AGPL/notice": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "MPL-2.0/header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
        You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense/text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws,
        the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public
        at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights
        to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0/long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Zlib/text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
        product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not
        be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
}


def _hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text."""
    return next(blocks(pa.array([text]), ALNUM, lower=True, most=1 << 40)).hashes()


def winnow(hashes: np.ndarray, window: int = WINNOW) -> list[int]:
    """Places of the least hash of every `window` neighbours, the last of equals; all of a shorter row's least."""
    if not len(hashes):
        return []
    kept, w = [], min(window, len(hashes))
    for a in range(len(hashes) - w + 1):
        part = hashes[a : a + w]
        at = a + w - 1 - int(np.argmin(part[::-1]))
        if not kept or kept[-1] != at:
            kept.append(at)
    return sorted(set(kept))


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    keys: np.ndarray
    places: list[list[tuple[int, int]]]  # of each key: template and place

    @classmethod
    def build(cls, templates: Mapping[str, str]) -> "Index":
        found: dict[int, list[tuple[int, int]]] = {}
        names, words = [], []
        for name, text in sorted(templates.items()):
            own = _hashes(text)
            if not len(own):
                continue
            if len(own) < GRAM:
                raise ValueError(f"template {name} has fewer than {GRAM} words")
            grams = window_hashes(own, GRAM)
            for at in winnow(grams):
                found.setdefault(int(grams[at]), []).append((len(names), at))
            names.append(name)
            words.append(own)
        keys = np.array(sorted(found), np.uint64)
        return cls(names, words, keys, [found[int(k)] for k in keys])


def align(template: np.ndarray, words: np.ndarray, band: int) -> tuple[int, int]:
    """Most words that the template has in common with the words, in order and from the first on, within band of the diagonal; and the fewest words that hold them."""
    width = 2 * band + 1
    padded = np.zeros(len(template) + width, np.uint64)
    there = np.zeros(len(padded), bool)
    n = min(len(words), len(template) + band)
    padded[band : band + n], there[band : band + n] = words[:n], True
    row = np.zeros(width + 1, np.int64)
    for i, want in enumerate(template):
        same = (padded[i : i + width] == want) & there[i : i + width]
        # leave the template's word out, or match it; then leave words of the document out
        row[:width] = np.maximum.accumulate(np.maximum(row[1:], row[:width] + same))
    if not row.max():
        return 0, 0
    return int(row.max()), len(template) - 1 + int(row[:width].argmax()) - band + 1


def _place(template: np.ndarray, words: np.ndarray, at: int, place: int, lo: int, hi: int, coverage: float) -> tuple[int, int, int]:
    """Matched words and span of the template around the GRAM words at `at`, which are its words at `place`, inside words[lo:hi]."""
    band = max(2, int(np.ceil((1 - coverage) * len(template))))
    before, left = align(template[:place][::-1], words[max(lo, at - place - band) : at][::-1], band) if place else (0, 0)
    rest = template[place + GRAM :]
    after, right = align(rest, words[at + GRAM : min(hi, at + GRAM + len(rest) + band)], band) if len(rest) else (0, 0)
    return before + GRAM + after, at - left, at + GRAM + right


def find(hashes: np.ndarray, index: Index, coverage: float = COVERAGE) -> list[tuple[str, float, int, int]]:
    """(template, coverage, first word, end word) of the places in one document, by first word; none overlap, and those with most words matched, less those missing, go first."""
    grams = window_hashes(hashes, GRAM)
    queue: list[tuple] = []

    def push(t: int, at: int, place: int, lo: int, hi: int) -> None:
        matched, a, b = _place(index.words[t], hashes, at, place, lo, hi, coverage)
        if matched >= coverage * len(index.words[t]):
            heapq.heappush(queue, (len(index.words[t]) - 2 * matched, b - a, index.names[t], a, at, place, t, b, matched))

    seen: set[tuple[int, int]] = set()
    for at in np.flatnonzero(np.isin(grams, index.keys)).tolist():
        for t, place in index.places[int(np.searchsorted(index.keys, grams[at]))]:
            if (t, at - place) not in seen:  # hits on one diagonal are of one place
                seen.add((t, at - place))
                push(t, at, place, 0, len(hashes))
    starts: list[int] = []
    taken: dict[int, tuple[int, str, float]] = {}
    while queue:
        _, _, name, a, at, place, t, b, matched = heapq.heappop(queue)
        k = bisect.bisect_right(starts, at)
        lo = taken[starts[k - 1]][0] if k else 0
        hi = starts[k] if k < len(starts) else len(hashes)
        if lo > at or hi < at + GRAM:
            continue  # the hit itself is taken
        if a < lo or b > hi:
            push(t, at, place, lo, hi)  # anew in what is free
            continue
        bisect.insort(starts, a)
        taken[a] = (b, name, matched / len(index.words[t]))
    return [(taken[a][1], taken[a][2], a, taken[a][0]) for a in starts]


MATCHES = "array<struct<license:string,coverage:double,start_word:int,end_word:int,start_byte:int,end_byte:int>>"


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and matches of every row: template, share of its words matched in order, span in words and in UTF-8 bytes.

    Words are runs of digits, ASCII letters and non-ASCII bytes, A-Z lower-cased, compared by 64 bits of hash. A place needs one
    fingerprint of the template whole, GRAM words; more words than may be missing are not skipped between matches. A null or empty text has no words and no
    matches. Rows are judged one by one; repeated rows give equal results, other columns are not read. Templates are
    a list kept in code or given by the caller, a few hundred words each; they travel with the tasks.
    """
    index = Index.build(templates)
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start_word", pa.int32()), ("end_word", pa.int32()), ("start_byte", pa.int32()), ("end_byte", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), ALNUM, lower=True):
                hashes = block.hashes()
                hit = np.unique(block.doc_of()[: max(0, len(hashes) - GRAM + 1)][np.isin(window_hashes(hashes, GRAM), index.keys)]) if len(hashes) >= GRAM else []
                matches: list[list[dict]] = [[] for _ in range(len(block))]
                for i in (int(x) for x in hit):
                    a, b = int(block.first[i]), int(block.first[i + 1])
                    base = int(block.offsets[i])
                    for name, share, s, e in find(hashes[a:b], index, coverage):
                        matches[i].append({"license": name, "coverage": share, "start_word": s, "end_word": e, "start_byte": int(block.starts[a + s]) - base, "end_byte": int(block.ends[a + e - 1]) - base})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.row, len(block)), pa.array(np.diff(block.first).astype(np.int64)), pa.array(matches, kind)], ["doc_id", "n_words", "matches"])

    return read.mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, n_words long, matches {MATCHES}")
