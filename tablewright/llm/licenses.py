"""License scan: passages against licence templates by Dice coefficient over word bigrams.

A passage is a run of neighbouring words, wherever lines break. Texts and
templates are normalised to lower-case words of letters and digits. Dice of at
least ``t`` needs |A| >= |B| t / (2 - t) and |A| <= |B| (2 - t) / t, so a
template is compared only with texts that hold enough of its bigrams, and only
with passages of such sizes that begin and end with one of them: without
foreign words at its ends the Dice of a passage is higher. All passages that
begin anywhere are measured at once, one more bigram of the template at a time.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from math import ceil, floor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.llm import words as W

THRESHOLD = 0.8

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:"
)
_BSD_SOURCE = (
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer."
)
_BSD_BINARY = (
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
)

# fixed values: notices and whole licences as they word themselves
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-header": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    ),
    "bsd-redistribution": _BSD,
    "bsd-2-clause": _BSD + _BSD_SOURCE + _BSD_BINARY + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_DISCLAIMER,
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "isc": _ISC,
    "isc-full": _ISC + (
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": _MIT,
    "mit-full": _MIT + (
        ", subject to the following conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-full": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}


def normalised(text: str) -> list[bytes]:
    data = W.LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
    found = W.find_words(data, np.array([0, len(data)]), W.ALPHANUMERIC)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(found.starts, found.ends)]


def bigrams(words: Sequence) -> Counter:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 0.0


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams a passage may have to reach ``threshold`` with a template of ``size``."""
    return ceil(size * threshold / (2 - threshold) - 1e-9), floor(size * (2 - threshold) / threshold + 1e-9)


class Template(NamedTuple):
    """Bigram hashes of a template, ascending, how often it holds each, and the number of all its bigrams."""

    grams: np.ndarray
    times: np.ndarray
    size: int


def template(text: str) -> Template:
    piece = next(W.slices(pa.array([text]), 1 << 30))
    data = W.LOWER[piece.data]
    hashes = W.run_hashes(W.word_hashes(data, W.find_words(data, piece.bounds, W.ALPHANUMERIC)), 2)
    grams, times = np.unique(hashes, return_counts=True)
    return Template(grams, times, len(hashes))


def passages(places: np.ndarray, grams: np.ndarray, known: Template, threshold: float) -> list[tuple[int, int, float]]:
    """First bigram, last bigram and Dice of the passages of one text that fit a template.

    ``places`` are the bigrams of the text that the template holds, ascending,
    and ``grams`` says which of the template's each is. Of all passages that
    begin with one of them the best counts, the shortest of equals; of
    overlapping ones the best, then the first.
    """
    _, high = size_bounds(known.size, threshold)
    n = len(places)
    # a bigram adds to what is shared unless the passage holds it as often as the template already
    order = np.argsort(grams, kind="stable")
    back = np.arange(n) - known.times[grams[order]]
    same = (back >= 0) & (grams[order][np.maximum(back, 0)] == grams[order])
    before = np.full(n, -1)
    before[order] = np.where(same, order[np.maximum(back, 0)], -1)
    shared, best, end = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
    for more in range(min(n, high)):
        begins = n - more
        size = places[more:] - places[:begins] + 1
        shared[:begins] += before[more:] < np.arange(begins)
        if size.min() > high:
            break
        value = np.where(size <= high, 2 * shared[:begins] / (size + known.size), 0.0)
        better = np.flatnonzero(value > best[:begins] + 1e-12)
        best[better] = value[better]
        end[better] = better + more
    found = np.flatnonzero(best >= threshold - 1e-12)
    taken: list[tuple[int, int]] = []
    out = []
    for value, first, last in sorted((-best[k], int(places[k]), int(places[end[k]])) for k in found.tolist()):
        at = bisect_left(taken, (first, last))
        # a bigram reaches into the next word
        if (at == 0 or taken[at - 1][1] + 1 < first) and (at == len(taken) or last + 1 < taken[at][0]):
            taken.insert(at, (first, last))
            out.append((first, last, -value))
    return sorted(out)


PASSAGE = "struct<template:string,start:int,end:int,first:int,last:int,dice:double>"


def licence_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text",
    templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """Id and the licence passages of every row: template, words ``start`` to ``end`` (exclusive), first and last line, dice.

    Words and lines count from 0. NULL and empty texts have none; repeated rows
    each get their own. Other columns are ignored. Templates of fewer than two
    words never match.
    """
    known = {n: t for n, t in ((n, template(t)) for n, t in sorted(templates.items())) if t.size}
    # how many of its bigrams a passage needs at least
    needs = {n: ceil(threshold / 2 * (size_bounds(t.size, threshold)[0] + t.size) - 1e-9) for n, t in known.items()}
    listed = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[t.grams for t in known.values()]]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), *[pa.int32()] * 4, pa.float64()]
        for batch in batches:
            rows = []
            for piece in W.slices(batch.column(1)):
                data = W.LOWER[piece.data]
                found = W.find_words(data, piece.bounds, W.ALPHANUMERIC)
                hashes = W.run_hashes(W.word_hashes(data, found), 2)
                at = np.flatnonzero(np.isin(hashes, listed) & W.whole_runs(found.of, 2))
                edges = np.searchsorted(at, found.of)
                breaks = np.flatnonzero(piece.data == 0x0A)
                for d in range(piece.last - piece.first):
                    own = at[edges[d]:edges[d + 1]]
                    line = np.searchsorted(breaks, piece.bounds[d])
                    met = []
                    for name, t in known.items():
                        if len(own) < needs[name]:
                            continue
                        gram = np.searchsorted(t.grams, hashes[own])
                        held = np.flatnonzero(t.grams[np.minimum(gram, len(t.grams) - 1)] == hashes[own])
                        if len(held) < needs[name]:
                            continue
                        for first, last, value in passages(own[held], gram[held], t, threshold):
                            lines = np.searchsorted(breaks, found.starts[[first, last + 1]]) - line
                            met.append((name, first - int(found.of[d]), last + 2 - int(found.of[d]), int(lines[0]), int(lines[1]), value))
                    rows.append(sorted(met, key=lambda p: (p[1], p[2], p[0])))
            cells = list(zip(*[p for r in rows for p in r])) or [()] * 6
            kind = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["template", "start", "end", "first", "last", "dice"])
            ends = np.cumsum([0, *[len(r) for r in rows]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), kind)], [id, "passages"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id), F.col(text)).mapInArrow(work, f"`{id}` {kind}, passages array<{PASSAGE}>")
