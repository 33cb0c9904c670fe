"""License scan: Dice coefficient over word bigrams between passages and licence templates.

A passage is any stretch of the word stream. With n bigrams, of which h are the
template's (each counted as often as the template has it at most), it is near a
template of m bigrams if 2h >= least * (n + m): the sum of 2 - least for each
shared bigram and -least for each other one must reach least * m. So the best
stretch of a template is one of largest sum, found by one pass over its hits,
and a template with too few hits in the whole text is never looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, find_words, hash_words, mix, text_blocks

#: Notices as their licences give them.
TEMPLATES: dict[str, str | list[str]] = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSD-3-Clause line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
NOT_WORDS = re.compile(r"[^\w\n]+")


def plain(text: str | None) -> str:
    """Lower case, words by single spaces, line ends kept."""
    return NOT_WORDS.sub(" ", (text or "").lower())


class Templates:
    """Bags of the templates' bigrams, and a sorted table of (bigram, template) to find hits of a text."""

    def __init__(self, texts: dict[str, str | list[str]], least: float):
        self.least, self.low = least, least / (2 - least)  # sizes of two bags with Dice >= least differ by this factor at most
        self.names, self.bags = [], []
        for name, text in sorted(texts.items()):
            for one in [text] if isinstance(text, str) else text:
                data = np.frombuffer(" ".join(plain(one).split()).encode(), np.uint8)
                starts, ends, _ = find_words(data, np.array([0, len(data)]))
                if len(starts) > 1:
                    self.names.append(name)
                    self.bags.append(Counter(pair_hashes(hash_words(data, starts, ends)).tolist()))
        self.sizes = np.array([b.total() for b in self.bags], np.int64)
        rows = sorted((k, t) for t, bag in enumerate(self.bags) for k in bag)
        self.keys, self.of = np.array([k for k, _ in rows], U64), np.array([t for _, t in rows], np.int64)

    def hits(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, template) of each bigram that a template has."""
        lo, hi = np.searchsorted(self.keys, pairs, "left"), np.searchsorted(self.keys, pairs, "right")
        at = np.flatnonzero(hi > lo)
        n = (hi - lo)[at]
        entry = np.repeat(lo[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.of[entry]


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * U64(0xD6E8FEB86659FD93) + hashes[1:])


def best_end(places: list[int], keys: list[int], bag: Counter, least: float, goal: float) -> tuple[int, int, int]:
    """First and last hit of the stretch of largest sum among those from the first hit on that reach `goal` before the sum falls to 0, and where the scan ended; the last hit is -1 if none reaches it."""
    start, score, best, end, used = 0, 0.0, 0.0, -1, Counter()
    for i, (place, key) in enumerate(zip(places, keys, strict=True)):
        if i > start:
            score -= least * (place - places[i - 1] - 1)
            if score <= 0:
                if best >= goal:
                    return start, end, i
                start, score, best, end = i, 0.0, 0.0, -1
                used.clear()
        used[key] += 1
        score += 2 - least if used[key] <= bag[key] else -least
        if score > best:
            best, end = score, i
    return start, end if best >= goal else -1, len(places)


def passages(places: list[int], keys: list[int], bag: Counter, size: int, least: float) -> Iterator[tuple[int, int, float]]:
    """(first bigram, last bigram, Dice) of stretches near one template, given its hits in a text, without overlap.

    A scan that finds none though it had enough hits is tried again from an
    eighth of the template on, as hits before a notice may have used up its bigrams.
    """
    goal, k = least * size - 1e-9, 0
    enough = goal / (2 - least)
    while len(places) - k >= enough:
        start, end, stop = best_end(places[k:], keys[k:], bag, least, goal)
        if end < 0:
            k += max(1, size // 8) if stop - start >= enough else stop
            continue
        lo, hi = k + start, k + end
        # the same backwards gives the best beginning for this end
        back = best_end([-x for x in places[lo : hi + 1]][::-1], keys[lo : hi + 1][::-1], bag, least, goal)
        lo = hi - back[1] if back[1] >= 0 and back[0] == 0 else lo
        n, shared = places[hi] - places[lo] + 1, (Counter(keys[lo : hi + 1]) & bag).total()
        if 2 * shared >= least * (n + size) - 1e-9:
            yield places[lo], places[hi], 2 * shared / (n + size)
        k = hi + 1


def scan_block(data: np.ndarray, offsets: np.ndarray, templates: Templates) -> list[tuple[int, int, int, str, float, int]]:
    """(row, first line, last line, licence, dice, bigrams) in plain texts.

    Of passages that overlap the one stays that exceeds the least Dice by most
    bigrams; ties go to the earlier, then to the smaller name.
    """
    starts, ends, rows = find_words(data, offsets)
    pairs = pair_hashes(hash_words(data, starts, ends))
    if not len(pairs):
        return []
    place, template = templates.hits(pairs)
    inner = rows[place] == rows[place + 1]
    place, template = place[inner], template[inner]
    order = np.lexsort((place, template, rows[place]))
    place, template = place[order], template[order]
    row = rows[place]
    begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (template[1:] != template[:-1])])) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([begin, [len(row)]]))
    enough = size >= templates.low * templates.sizes[template[begin]] - 1e-9
    breaks, found = np.flatnonzero(data == 10), {}
    for b, n in zip(begin[enough].tolist(), size[enough].tolist(), strict=True):
        t = int(template[b])
        for lo, hi, share in passages(place[b : b + n].tolist(), pairs[place[b : b + n]].tolist(), templates.bags[t], int(templates.sizes[t]), templates.least):
            n_own = hi - lo + 1
            found.setdefault(int(row[b]), []).append(((templates.least - share) * (n_own + int(templates.sizes[t])), lo, templates.names[t], hi, share))
    out = []
    for r, hits in sorted(found.items()):
        taken: list[tuple[int, int]] = []
        before = int(np.searchsorted(breaks, offsets[r]))
        for _, lo, name, hi, share in sorted(hits):
            if all(hi < a or b < lo for a, b in taken):
                taken.append((lo, hi))
                lines = np.searchsorted(breaks, starts[[lo, hi + 1]]) - before
                out.append((r, int(lines[0]), int(lines[1]), name, share, hi - lo + 1))
    return sorted(out)


def scan_licenses(docs: DataFrame, templates: dict[str, str | list[str]] | None = None, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, first_line, last_line (from 0), license, dice, n_bigrams for each passage near a template.

    A passage is any stretch of words, within a line or over several; of those
    near a template that overlap one is given (see scan_block), so licences one
    behind the other, and a notice within a whole licence file, are all found.
    A name may have several texts. Texts without licences, null and empty ones
    and empty tables give no row; whole texts are read, a very long one in a
    block of its own; repeated rows each give theirs. Templates are a parameter
    and go with the tasks.
    """
    known = docs.sparkSession.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates, least))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = pa.array([plain(t) for t in part.column(1).to_pylist()], pa.large_string())
                found = [(a + row, *rest) for a, _, data, offsets in text_blocks(texts) for row, *rest in scan_block(data, offsets, known.value)]
                columns = list(zip(*found, strict=True)) or [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(arrays[0]), *arrays[1:]], ["doc_id", "first_line", "last_line", "license", "dice", "n_bigrams"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(scan, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, first_line long, last_line long, license string, dice double, n_bigrams long")
