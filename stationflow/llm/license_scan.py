"""Licence notices in texts, by Dice coefficient over word bigrams."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationflow.llm.common import ids_and_text
from stationflow.llm.decontaminate import words_of

DICE = 0.8
WORDS_AT_ONCE = 1 << 20
SCHEMA = "doc_id long, license string, dice double, word_start long, n_words long"
ARROW = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("word_start", pa.int64()), ("n_words", pa.int64())])

# Notices of public licences, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("WTFPL", "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2."),
]


class Templates:
    """Templates as multisets of word bigrams."""

    def __init__(self, templates: list[tuple[str, str]], dice: float = DICE) -> None:
        texts = [(name, words_of(text)) for name, text in templates]
        texts = [(name, words) for name, words in texts if len(words) > 1]
        self.names, self.dice = [name for name, _ in texts], dice
        self.vocab: dict[str, int] = {}
        for _, words in texts:
            for w in words:
                self.vocab.setdefault(w, len(self.vocab) + 1)
        self.base = len(self.vocab) + 1
        self.bags = [Counter(self.codes(np.array([self.vocab[w] for w in words])).tolist()) for _, words in texts]
        self.size = np.array([sum(b.values()) for b in self.bags], np.int64)
        #: windows that can reach the threshold have no fewer and no more bigrams than this, however alike they are
        self.least = np.ceil(self.size * dice / (2 - dice) - 1e-9).astype(np.int64)
        self.most = np.floor(self.size * (2 - dice) / dice + 1e-9).astype(np.int64)
        pairs = sorted((code, k) for k, bag in enumerate(self.bags) for code in bag)
        self.code, self.of = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)

    def codes(self, words: np.ndarray) -> np.ndarray:
        """A number for each bigram; 0 if a word is in no template."""
        return np.where((words[:-1] > 0) & (words[1:] > 0), words[:-1] * self.base + words[1:], 0)

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int, int]]:
        """``row, template, dice, word start, words`` of the notices of each text."""
        rows: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        for row, text in enumerate(texts):
            found = words_of(text)
            rows.append(row)
            parts.append(np.fromiter(map(self.vocab.get, found, repeat(0)), np.int64, len(found)))
            held += len(found)
            if held >= WORDS_AT_ONCE:
                yield from self._find(rows, parts)
                rows, parts, held = [], [], 0
        yield from self._find(rows, parts)

    def _find(self, rows: list[int], parts: list[np.ndarray]) -> Iterator[tuple[int, int, float, int, int]]:
        gap = np.zeros(1, np.int64)  # no bigram crosses documents
        words = np.concatenate([x for p in parts for x in (p, gap)]) if parts else gap
        first = np.cumsum([0, *(len(p) + 1 for p in parts)])
        codes = self.codes(words)
        spots = np.flatnonzero(codes)
        lo, hi = np.searchsorted(self.code, codes[spots]), np.searchsorted(self.code, codes[spots], "right")
        spots, lo, count = spots[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(spots):
            return
        kind = self.of[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        spot = np.repeat(spots, count)
        doc = np.searchsorted(first, spot, "right") - 1
        # the hits of one document and template, in order of place
        group = doc * len(self.names) + kind
        order = np.lexsort((spot, group))
        spot, group, kind, doc = spot[order], group[order], kind[order], doc[order]
        # a window needs as many hits as its least size, within its greatest size
        last = np.arange(len(spot)) + self.least[kind] - 1
        fits = last < len(spot)
        last = np.minimum(last, len(spot) - 1)
        begins = np.flatnonzero(fits & (group[last] == group) & (spot[last] - spot < self.most[kind]))
        found: dict[int, list[tuple]] = {}
        for i, d, k in zip(begins.tolist(), doc[begins].tolist(), kind[begins].tolist(), strict=True):
            stop = i + int(np.searchsorted(group[i : i + int(self.most[k])], group[i], "right"))
            stop = i + int(np.searchsorted(spot[i:stop], spot[i] + self.most[k]))
            best = self._best(codes[spot[i:stop]].tolist(), (spot[i:stop] - spot[i] + 1).tolist(), k)
            if best:
                found.setdefault(d, []).append((-best[0], -int(self.size[k]), int(spot[i]), k, int(spot[i]) + best[1]))
        for d in sorted(found):
            taken: list[tuple[int, int]] = []
            for score, _, s, k, e in sorted(found[d]):
                at = bisect_left(taken, (s, e))
                if (at == 0 or taken[at - 1][1] < s) and (at == len(taken) or taken[at][0] > e):
                    taken.insert(at, (s, e))
                    yield rows[d], k, -score, s - int(first[d]), e - s + 1

    def _best(self, codes: list[int], widths: list[int], k: int) -> tuple[float, int] | None:
        """Of the windows from the first hit to each later one, given their bigrams: the best Dice and its size; the shorter of equal ones."""
        bag, size, least = self.bags[k], int(self.size[k]), int(self.least[k])
        seen: dict[int, int] = {}
        common, best = 0, None
        for code, width in zip(codes, widths, strict=True):
            n = seen[code] = seen.get(code, 0) + 1
            if n <= bag[code]:
                common += 1
                if width >= least and (score := 2 * common / (width + size)) >= self.dice - 1e-12 and (best is None or score > best[0]):
                    best = score, width
        return best


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, dice: float = DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, license, dice, word_start, n_words``, one row for each licence notice of each whole text.

    Texts and templates are lower-cased runs of letters and digits. A window of w bigrams reaches
    ``dice`` against a template of t only if w lies between t d / (2 - d) and t (2 - d) / d;
    all windows of these sizes that begin and end at a bigram of the template count, as one that
    doesn't is less alike than what remains without its ends. A template is passed over
    where too few of its bigrams lie near. Of each place's windows the closest is taken (the
    shorter of equals); of windows that overlap, the closest stays, then the longer template's,
    then the first. Null and empty texts have no notice; rows without an id are scanned too, with a null id;
    repeated rows are scanned once each; whole texts are scanned; other columns are left out; an
    empty table gives an empty result. ``templates`` is a list the caller holds, so what goes to
    the executors is as small.
    """
    index = Templates(templates, dice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            hits = [(ids[r], index.names[k], score, start, n) for r, k, score, start, n in index.find(batch.column(1).to_pylist())]
            columns = list(zip(*hits, strict=True)) or [[]] * len(ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)

    return ids_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
