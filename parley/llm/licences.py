"""Operator 7, licence scans: MinHash bands over overlapping windows, then exact containment.

Words are runs of ASCII letters, digits and bytes over 127, in lower case; shingles have SHINGLE
words. A text's shingles are cut into blocks, and windows of two neighbouring blocks overlap by one,
so that every run of a block's length lies whole in a window. Templates are looked for in the windows whose block is
at least as long as they are, the shortest such of the powers of two from BLOCK on. A window's and a
template's signatures are minima under BANDS hashes, a band each: of a template all of whose shingles stand in a window,
of which they are a fifth or more, all bands miss with a probability under 1e-6. A band that agrees gives a candidate; it counts if the
window holds MIN_CONTAINED of the template's shingles, exactly.

Defined results: null or empty text, or fewer than SHINGLE words: no row. Null doc_id is an ordinary value. Rows that
repeat give rows each. A text of any length is scanned whole. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents
from .textops import Chunk, chunks, distinct

# Notices and whole texts of short public licences, and sentences by which longer ones are named.
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_TERMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_USEFUL = "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", _AS_IS),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed " + _USEFUL + " See the GNU General Public License for more details."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed " + _USEFUL + " See the GNU General Public License for more details."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed " + _USEFUL + " See the GNU Lesser General Public License for more details."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed " + _USEFUL + " See the GNU Affero General Public License for more details."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("BSD-2-Clause", _TERMS),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", _BSD),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
)
SHINGLE, BLOCK, BANDS, MIN_CONTAINED = 3, 8, 64, 0.8
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FACTORS = np.random.default_rng(17).integers(1, 1 << 62, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _band(shingles: np.ndarray, j: int) -> np.ndarray:
    return (shingles ^ (shingles >> np.uint64(31))) * _FACTORS[j]


@dataclass
class Template:
    name: str
    shingles: np.ndarray  # sorted, distinct
    level: int  # its block holds BLOCK << level shingles
    minima: np.ndarray  # a value for each band


def templates(texts: Sequence[tuple[str, str]] = TEMPLATES) -> list[Template]:
    """The templates that have a shingle."""
    out = []
    for name, text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        found, _ = Chunk(0, raw, np.array([0, len(raw)])).words(lower=True, between=_BETWEEN).windows(SHINGLE)
        if len(found):
            level = max(0, int(np.ceil(np.log2(len(found) / BLOCK))))
            out.append(Template(name, distinct(found), level, np.array([_band(found, j).min() for j in range(BANDS)], np.uint64)))
    return out


def _levels(begin: np.ndarray, ends: np.ndarray, docs: np.ndarray, n: int) -> list[tuple[np.ndarray, ...]]:
    """Blocks of each level: documents, starts of windows, their ends, whether the next block is of the same document, those that are joined
    with the next one for the level above, and those that stay there."""
    out, starts = [], begin
    for _ in range(n):
        pair = np.append(docs[1:] == docs[:-1], False)
        stop = np.where(pair, np.append(ends[1:], 0), ends)
        even = (np.arange(len(docs)) - np.searchsorted(docs, docs)) % 2 == 0
        joined = even & pair
        out.append((docs, starts, stop, pair, joined, even))
        docs, starts, ends = docs[even], starts[even], np.where(joined, stop, ends)[even]
    return out


def scan(chunk: Chunk, known: list[Template]) -> list[tuple[int, int, float, int, int]]:
    """(document, template, containment, first word, end word) of the best windows: one row for
    each document and template."""
    w = chunk.words(lower=True, between=_BETWEEN)
    found, at = w.windows(SHINGLE)
    if not len(found):
        return []
    owner = w.doc[at]
    word = at - (np.cumsum(w.counts) - w.counts)[owner]  # in its document
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    size = np.diff(np.append(first, len(owner)))
    # blocks of the lowest level; the upper ones join two each, within a document
    blocks = -(-size // BLOCK)
    begin = np.repeat(first - BLOCK * (np.cumsum(blocks) - blocks), blocks) + BLOCK * np.arange(int(blocks.sum()))
    of = np.repeat(np.arange(len(first)), blocks)
    hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
    levels = _levels(begin, np.append(begin[1:], len(found)), of, max(t.level for t in known) + 1)
    for j in range(BANDS):
        low = np.minimum.reduceat(_band(found, j), begin)
        for level, (docs, starts, stop, pair, joined, even) in enumerate(levels):
            window = np.where(pair, np.minimum(low, np.append(low[1:], low[-1:])), low)
            for k, t in enumerate(known):
                if t.level == level:
                    for i in np.flatnonzero(window == t.minima[j]):
                        hits.setdefault((int(docs[i]), k), []).append((int(starts[i]), int(stop[i])))
            low = np.where(joined, window, low)[even]
    out = []
    for (d, k), windows in hits.items():
        t = known[k].shingles
        best = None
        for a, z in sorted(set(windows)):
            there = np.isin(found[a:z], t)
            part = len(distinct(found[a:z][there])) / len(t)
            if part >= MIN_CONTAINED and (best is None or part > best[0]):
                where = np.flatnonzero(there) + a
                best = (part, int(word[where[0]]), int(word[where[-1]]) + SHINGLE)
        if best:
            out.append((int(owner[first[d]]), k, *best))
    return sorted(out)


def scanned(df: DataFrame, texts: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document and licence template found: doc_id, licence, template, containment, first_word, end_word."""
    texts = tuple(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates(texts)
        for b in batches:
            rows = [(c.first + d, k, *rest) for c in chunks(b.column("text")) for d, k, *rest in (scan(c, known) if known else [])]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array([known[k].name for k in cols[1]], pa.string()), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.float64(), pa.int64(), pa.int64())))],
                names=["doc_id", "licence", "template", "containment", "first_word", "end_word"],
            )

    return documents(df).mapInArrow(run, "doc_id long, licence string, template int, containment double, first_word long, end_word long")
