"""Licence scans by a positional index of rare licence words.

The words of licence templates are indexed by template and position. How rare a licence word is comes from the number of
documents of the whole corpus that have it. Of each file the licence words are looked up, those of highest IDF first: a
template is looked at if the file has the rarest word of its key phrases, and then all other words of these. The postings
of the template's ``RARE`` rarest words are intersected by relative position: each occurrence in the file, less the word's
place in the template, is an offset, and a place of the template needs ``AGREE`` of the rare words at about its offset.

A licence is often printed with words put in, left out or changed, such as the holder's name. So offsets may drift, by
``DRIFT`` words and one more for every ``STRETCH`` words between. A place is where the first mandatory key phrase stands;
each further one must stand, word by word, where its offset has drifted no further than that from the one before, the
nearest if there are several; and a rare word counts if it stands as near to where the nearest key phrase wants it. A word
changed within a key phrase loses the label: it is mandatory. Nothing that fulfils this is lost. Base phrases are places of
their own words alone.

Defined cases: a null or empty text has no words and no labels. Repeated rows and null doc_ids are each returned. Other
columns are ignored. Words count from 0. A template may begin before a file's first word or end after its last, if enough
of it is there. Of equally rare words of a template the earlier ones are taken.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A place needs this share of the template's rare words at their relative positions.
AGREE = 0.5
#: Of each template so many of its rarest words are intersected.
RARE = 12
#: Words by which a template's parts may be out of place, and words between them that allow one more.
DRIFT, STRETCH = 4, 8


@dataclass(frozen=True)
class Template:
    """A licence's text or notice, and the phrases of it that must be there word by word."""

    label: str
    text: str
    keys: tuple[str, ...]


# Phrases and labels of the contract.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Sentences of licences that often stand alone, with the phrases that must be there.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", ("without any express or implied warranty",)),
)

_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR
A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
_SOFTWARE_USE = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
_GNU = """you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation,
either version {} of the License, or (at your option) any later version. This program is distributed in the hope that it will
be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU {} for more details."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

# The texts of short licences, without their copyright lines, and the notices that long ones prescribe.
TEXTS = (
    Template("mit", _GRANT, ("permission is hereby granted free of charge", "sublicense and or sell copies of the software")),
    Template("bsd-2-clause", f"{_BSD_TWO} {_BSD_END}", ("redistribution and use in source and binary forms", "provided with the distribution this software is provided by")),
    Template("bsd-3-clause", f"{_BSD_TWO} {_BSD_THIRD} {_BSD_END}", ("redistribution and use in source and binary forms", "to endorse or promote products derived from this software")),
    Template("isc", f"{_SOFTWARE_USE}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}", ("with or without fee is hereby granted provided that",)),
    Template("0bsd", f"{_SOFTWARE_USE}. {_ISC_END}", ("with or without fee is hereby granted the software is provided",)),
    Template("zlib", _ZLIB, ("altered source versions must be plainly marked as such",)),
    Template("unlicense", _UNLICENSE, ("free and unencumbered software", "overt act of relinquishment in perpetuity")),
    Template("bsl-1.0", _BOOST, ("machine executable object code generated by a source language processor",)),
    Template("apache-2.0", _APACHE, ("under the apache license version 2 0",)),
    Template("gpl-2", _GNU.format("General Public License", "2", "General Public License"), ("gnu general public license", "either version 2 of the license")),
    Template("gpl-3", _GNU.format("General Public License", "3", "General Public License"), ("gnu general public license", "either version 3 of the license")),
    Template("lgpl-2.1", _GNU.format("Lesser General Public License", "2.1", "Lesser General Public License"), ("gnu lesser general public license", "either version 2 1 of the license")),
    Template("agpl-3", _GNU.format("Affero General Public License", "3", "Affero General Public License"), ("gnu affero general public license", "either version 3 of the license")),
    Template("mpl-2.0", _MPL, ("mozilla public license v 2 0",)),
)
TEMPLATES = NOTICES + TEXTS

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: runs of digits, letters a-z after lower-casing A-Z, and whatever is not ASCII."""
    return (text or b"").translate(_FOLD).split()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), map(words_of, batch.column(1).cast(pa.binary()).to_pylist()), strict=True)


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[bytes, int]:
    """In how many of all documents each licence word is. The words are those of the templates and base phrases, so the
    result is of fixed size."""
    vocabulary = frozenset(w for t in (*[t.text for t in templates], *[p for _, p in BASE]) for w in words_of(t.encode()))

    def count(batches):
        seen = Counter()
        for _, words in _rows(batches):
            seen.update(vocabulary.intersection(words))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen]), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"].encode(): r["n"] for r in found}


@dataclass(frozen=True)
class Plan:
    """How a template is looked for: its words and their IDF, the positions of its rarest words, rarest first, how many of
    these must agree, and its key phrases with their positions."""

    label: str
    words: list[bytes]
    idf: list[float]
    rare: list[int]
    need: int
    keys: list[tuple[int, list[bytes]]]


def allowed(distance: int) -> int:
    """By how many words offsets of two parts of a template may differ that are ``distance`` words apart."""
    return DRIFT + distance // STRETCH


def nearest(offsets: list[int], wanted: int, most: int) -> int | None:
    """Of sorted offsets the one nearest to ``wanted``, the lower of equals, if it is no further than ``most`` from it."""
    k = bisect_left(offsets, wanted)
    best = min(offsets[max(k - 1, 0) : k + 1], key=lambda x: (abs(x - wanted), x), default=None)
    return best if best is not None and abs(best - wanted) <= most else None


class LicenceIndex:
    """The positional index: for each rare word of the templates the places where it stands in them."""

    def __init__(self, frequencies: dict[bytes, int], total: int, templates: tuple[Template, ...] = TEMPLATES):
        self.idf = {w: math.log((total + 1) / (n + 1)) + 1 for w, n in frequencies.items()}
        self.plans: list[Plan] = []
        self.postings: dict[bytes, list[tuple[int, int, int]]] = {}  # of each word (plan, its number among the rare, position)
        self.guards: dict[bytes, list[int]] = {}  # plans by the rarest word of their key phrases
        self.musts: list[frozenset[bytes]] = []
        for label, text, keys in [*[(lb, p, (p,)) for lb, p in BASE], *[(t.label, t.text, t.keys) for t in templates]]:
            words = words_of(text.encode())
            places = []
            for key in keys:
                k = words_of(key.encode())
                places.append((next(i for i in range(len(words)) if words[i : i + len(k)] == k), k))
            phrase = len(self.plans) < len(BASE)
            rare = sorted(range(len(words)), key=lambda i: (-self.idf[words[i]], i))[: None if phrase else RARE]
            places.sort()
            must = frozenset(w for _, k in places for w in k)
            self.guards.setdefault(max(must, key=lambda w: (self.idf[w], w)), []).append(len(self.plans))
            for n, i in enumerate(rare):
                self.postings.setdefault(words[i], []).append((len(self.plans), n, i))
            self.musts.append(must)
            self.plans.append(Plan(label, words, [self.idf[w] for w in words], rare, len(rare) if phrase else math.ceil(AGREE * len(rare)), places))

    def places(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(plan, start, end, score) of every template that stands in the words; score is its share of IDF mass found."""
        here = self.idf.keys() & set(words)
        wanted = {plan for w in here & self.guards.keys() for plan in self.guards[w] if self.musts[plan] <= here}
        if not wanted:
            return []
        where: dict[bytes, list[int]] = {w: [] for w in here if any(plan in wanted for plan, _, _ in self.postings.get(w, ()))}
        where |= {max(x, key=lambda w: (self.idf[w], w)): [] for k in wanted for _, x in self.plans[k].keys}
        for p, w in enumerate(words):
            if w in where:
                where[w].append(p)
        found = []
        for k in wanted:
            plan = self.plans[k]
            (first, key), *others = plan.keys
            starts = self._phrases(words, where, key)
            if k < len(BASE):
                found += [(k, p, p + len(key), 1.0) for p in starts]
                continue
            offsets = [sorted(p - i for p in where.get(plan.words[i], ())) for i in plan.rare]
            later = [(i, sorted(p - i for p in self._phrases(words, where, x))) for i, x in others]
            widest = allowed(len(plan.words))
            for p in starts:
                if sum(nearest(o, p - first, widest) is not None for o in offsets) < plan.need:
                    continue
                anchors = [(first, p - first)]
                for i, o in later:
                    anchors.append((i, nearest(o, anchors[-1][1], allowed(i - anchors[-1][0]))))
                    if anchors[-1][1] is None:
                        break
                else:
                    for i, o in zip(plan.rare, offsets, strict=True):
                        at, off = min(anchors[: len(plan.keys)], key=lambda x: abs(x[0] - i))
                        if (own := nearest(o, off, allowed(abs(i - at)))) is not None:
                            anchors.append((i, own))
                    if len(anchors) - len(plan.keys) >= plan.need:
                        found.append((k, *self._extent(words, plan, sorted(anchors))))
        return sorted(found)

    def _phrases(self, words: list[bytes], where: dict[bytes, list[int]], key: list[bytes]) -> list[int]:
        """Where a key phrase stands, by the places of its rarest word."""
        rarest = max(key, key=lambda w: (self.idf[w], w))
        a = key.index(rarest)
        return [p - a for p in where[rarest] if p >= a and words[p - a : p - a + len(key)] == key]

    @staticmethod
    def _extent(words: list[bytes], plan: Plan, anchors: list[tuple[int, int]]) -> tuple[int, int, float]:
        """Start and end of a template whose parts have these offsets, and the share of its IDF mass that is there: each word
        is looked for at the offsets of the parts before and behind it."""
        same, places = 0.0, [i for i, _ in anchors]
        for i, (x, v) in enumerate(zip(plan.words, plan.idf, strict=True)):
            k = bisect_right(places, i)
            if any(0 <= i + off < len(words) and words[i + off] == x for _, off in anchors[max(k - 1, 0) : k + 1]):
                same += v
        return max(anchors[0][1], 0), min(anchors[-1][1] + len(plan.words), len(words)), min(same / sum(plan.idf), 1.0)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "places array<struct<label:string,first:long,after:long,score:double>>"
)


def licences(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Each row's number of words, places of base phrases, labels, best score, and the places of all templates."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    index = LicenceIndex(document_frequencies(docs, templates), docs.count(), templates)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    place = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64()), ("score", pa.float64())]))
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), place]

    def scan(batches):
        out = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for doc_id, words in _rows(batches):
            found = index.places(words)
            base = [f for f in found if f[0] < len(BASE)]
            starts = [f[1] for f in base]
            label = lambda fs: ",".join(sorted({index.plans[f[0]].label for f in fs}))
            spans = [{"label": index.plans[p].label, "first": a, "after": b, "score": s} for p, a, b, s in sorted(found, key=lambda f: (f[1], f[0]))]
            out.append((doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), label(base), label(found), max((f[3] for f in found), default=0.0), spans))
            if len(out) == 2048:
                yield batch()
                out = []
        if out:
            yield batch()

    return docs.mapInArrow(scan, SCHEMA)
