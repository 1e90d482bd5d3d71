"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import alnum_words, row_slices
from sparkfolio.session import ship_package

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Fixed values: (label, notice) of public licenses: their notices and paragraphs whole, and names of at most four words,
# all of which a share of 0.8 asks for.
TEMPLATES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation"),
    ("lgpl", "Lesser General Public License"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("agpl", "GNU Affero General Public"),
    ("fdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("bsd", "bsd license"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "isc license"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("boost", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mpl", "Mozilla Public License"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("epl", "Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc0", "CC0 1.0 Universal"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc-by-sa", "CC BY-SA"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by-nc-sa", "CC BY-NC-SA"),
    ("cc-by-nc-nd", "CC BY-NC-ND"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("apache", "SPDX-License-Identifier: Apache"),
    ("bsd", "SPDX-License-Identifier: BSD"),
    ("gpl", "SPDX-License-Identifier: GPL"),
    ("lgpl", "SPDX-License-Identifier: LGPL"),
    ("agpl", "SPDX-License-Identifier: AGPL"),
    ("mpl", "SPDX-License-Identifier: MPL"),
)


class Templates:
    """Templates as sets in global frequency order, rarest word first, with an inverted index of their prefixes."""

    def __init__(self, templates, frequency: dict[bytes, int], share: float):
        self.share = share
        rank = lambda w: (frequency.get(w, 0), w)
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(set(alnum_words(text.encode())), key=rank) for _, text in templates]
        self.need = [math.ceil(share * len(s) - 1e-9) for s in self.sets]
        #: Words in a window: as long as the notice, with room for foreign words in the same share.
        self.reach = [int(len(alnum_words(text.encode())) / (share or 1) + 1e-9) for _, text in templates]
        self.order = {w: i for i, w in enumerate(sorted(set().union(*map(set, self.sets)), key=rank))} if self.sets else {}
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for t, (words, need) in enumerate(zip(self.sets, self.need, strict=True)):
            for place, w in enumerate(words[: len(words) - need + 1] if need else words):
                self.index.setdefault(w, []).append((t, place))
        self.prefix = frozenset(self.index)

    def match(self, block: list[bytes]) -> dict[int, float]:
        """Containment of each template that the block holds to the stated share; exact."""
        words = set(block)
        if self.prefix.isdisjoint(words):
            return {}
        known = sorted((w for w in words if w in self.order), key=self.order.__getitem__)
        shared: Counter[int] = Counter()
        for at, w in enumerate(known):
            for t, place in self.index.get(w, ()):
                # Length filter, then positional filter: words still to come on either side bound the overlap.
                if len(known) >= self.need[t] and shared[t] + 1 + min(len(self.sets[t]) - place, len(known) - at) - 1 >= self.need[t]:
                    shared[t] += 1
        out = {}
        for t in shared:
            n = sum(w in words for w in self.sets[t])
            if n >= self.need[t]:
                out[t] = n / len(self.sets[t])
        return out

    def windows(self, words: list[bytes], t: int) -> list[tuple[int, int, float]]:
        """(first word, last word, containment) of each run of overlapping windows that hold template t; the first and best of the run."""
        wanted = set(self.sets[t])
        at = [i for i, w in enumerate(words) if w in wanted]
        inside: Counter[bytes] = Counter()
        runs: list[list[int]] = []  # first word of the best, last word, distinct words of the best
        left = 0
        for right in at:
            inside[words[right]] += 1
            while right - at[left] >= self.reach[t] or inside[words[at[left]]] > 1:
                w = words[at[left]]
                inside[w] -= 1
                if not inside[w]:
                    del inside[w]
                left += 1
            if len(inside) >= max(1, self.need[t]):
                if runs and at[left] <= runs[-1][1]:
                    runs[-1][1] = right
                    if len(inside) > runs[-1][2]:
                        runs[-1][0], runs[-1][2] = at[left], len(inside)
                else:
                    runs.append([at[left], right, len(inside)])
        return [(first, last, n / len(wanted)) for first, last, n in runs]

    def blocks(self, text: bytes, words: list[bytes]) -> list[tuple[int, int, float, bool]]:
        """(line of the first word, template, containment, best) of every run of windows that hold a template.

        ``best``: no overlapping run of another label holds a greater share of
        its template, nor the same share of one with more words.
        """
        whole = self.match(words)
        if not whole:
            return []
        runs = [(first, last, t, share) for t in whole for first, last, share in self.windows(words, t)]
        ends, total = [], 0
        for line in text.split(b"\n"):
            total += len(alnum_words(line))
            ends.append(total)
        rank = lambda t, share: (share, len(self.sets[t]))
        out: dict[tuple[int, int], tuple[float, bool]] = {}
        reach: list[tuple[int, int, int, float]] = []  # runs that may overlap those to come
        better = dict.fromkeys(range(len(runs)), False)
        for k, (first, last, t, share) in sorted(enumerate(runs), key=lambda x: x[1][:2]):
            reach = [r for r in reach if r[1] >= first]
            for _, _, j, _ in reach:
                _, _, u, other = runs[j]
                if self.labels[u] != self.labels[t]:
                    better[k] |= rank(u, other) > rank(t, share)
                    better[j] |= rank(t, share) > rank(u, other)
            reach.append((first, last, k, share))
        for k, (first, _, t, share) in enumerate(runs):
            key = bisect_right(ends, first), t
            had = out.get(key, (0.0, False))
            out[key] = max(share, had[0]), had[1] or not better[k]
        return [(line, t, share, best) for (line, t), (share, best) in sorted(out.items())]


def places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, int]]:
    """(start word, phrase number) of every place where a phrase's words stand consecutively."""
    out = []
    for k, (phrase, _) in enumerate(phrases):
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(phrase)] == phrase:
                out.append((at, k))
    return out


def _count(batches, wanted: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    total: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column("text"):
            total.update(wanted.intersection(alnum_words(text.as_py())))
    if total:
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())})


def _scan(batches, templates: Templates, phrases) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            out: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "best_labels", "score", "blocks")}
            for i in rows:
                text = texts[i].as_py()
                words = alnum_words(text)
                hits = places(words, phrases)
                base = {phrases[k][1] for _, k in hits}
                blocks = [{"line": line, "label": templates.labels[t], "share": share, "best": best} for line, t, share, best in templates.blocks(text, words)]
                most = max((b["share"] for b in blocks), default=0.0)
                labels = base | {b["label"] for b in blocks}
                starts = [p for p, _ in hits]
                for c, v in (
                    ("n_words", len(words)), ("n_base", len(hits)), ("first_word", min(starts, default=None)),
                    ("last_word", max(starts, default=None)), ("base_labels", sorted(base)), ("labels", sorted(labels)),
                    ("best_labels", sorted({b["label"] for b in blocks if b["best"]})), ("score", 1.0 if hits else most), ("blocks", blocks),
                ):
                    out[c].append(v)
            kinds = (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(),
                pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("share", pa.float64()), ("best", pa.bool_())])),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(rows.start, len(rows)), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))],
                ["doc_id", *out],
            )


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, share: float = 0.8) -> DataFrame:
    """License phrases and notices in each whole text.

    A first pass counts in how many documents each template word occurs, over
    all documents; that order puts rare words first. A second pass looks at
    every text: words of a template's prefix find candidates, length and
    positions bound the overlap, and a set comparison decides. Templates that
    the text as a whole holds are then looked for in every window of its
    words (as long as the notice divided by ``share``), across lines: every
    window with at least ``share`` of a template's distinct words is found,
    however the notice is wrapped, and overlapping windows make one block.
    Words further apart than a window don't make a notice. Notices that are
    alike are all reported, each with its share; ``best`` tells those that no
    overlapping block of another label outdoes in share, then in words.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels (of phrases and all blocks), best_labels (of the best blocks),
    score and blocks (first line, label, share, best), a row per input row.
    ``score`` is 1 with a phrase, else the best share, else 0. Null text:
    empty. Empty input: no rows. Extra columns are ignored. Templates and
    phrases are parameters of a few entries; the frequency table has at most
    as many rows as templates have words.
    """
    ship_package(docs.sparkSession)
    wanted = frozenset(w for _, t in templates for w in alnum_words(t.encode()))
    text = docs.select(F.col("text").cast("binary").alias("text"))
    rows = text.mapInArrow(lambda b: _count(b, wanted), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    table = rows.toArrow().to_pydict()
    index = Templates(templates, dict(zip(table["word"], table["n"], strict=True)), share)
    split = [(alnum_words(p.encode()), label) for p, label in phrases.items()]
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda b: _scan(b, index, split),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, best_labels array<string>, score double, blocks array<struct<line:int,label:string,share:double,best:boolean>>",
    )
