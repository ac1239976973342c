"""Licence scans by Dice coefficient over word bigrams (operator 1)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import no_gc, table

PERCENT = 80
# Usual short notices of well-known licences, and the whole texts of the short licences.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
        express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS
        AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the
        names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
        HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
        LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE."""),
    ("LGPL-3.0", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
        published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
        any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions"""),
]
NOT_WORD = re.compile("[^a-z0-9]+")
BLANK_LINE = re.compile("\n[ \t\r]*\n")


def words_of(text: str) -> list[str]:
    """Words of the text, lower-cased and with all but a-z and 0-9 as white space."""
    return NOT_WORD.sub(" ", text.lower()).split()


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def bigrams(text: str) -> set[tuple[str, str]]:
    """Distinct pairs of neighbouring words of the text."""
    return pairs(words_of(text))


class Matcher:
    """Templates by size.  A coefficient of at least t needs sizes a and b with a >= t b / (2 - t), and the other way round."""

    def __init__(self, templates: list[tuple[str, str]], percent: int):
        self.percent = percent
        known = [(len(pairs(w)), name, pairs(w), w) for name, text in templates if len(w := words_of(text)) > 1]
        self.templates = sorted(known, key=lambda x: x[:2])
        sizes = [t[0] for t in self.templates] or [0]
        self.least = -(-percent * min(sizes) // (200 - percent))
        self.most = (200 - percent) * max(sizes) // percent
        self.places: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for t, (_, _, _, w) in enumerate(self.templates):
            for q, pair in enumerate(zip(w, w[1:], strict=False)):
                self.places.setdefault(pair, []).append((t, q))

    def shared(self, unit: set, t: int) -> tuple[int, float, str] | None:
        """(shared bigrams, coefficient, licence) if the unit is like the template."""
        n, p, (size, name, b, _) = len(unit), self.percent, self.templates[t]
        if size * p <= n * (200 - p) and n * p <= size * (200 - p):
            both = len(unit & b)
            if 200 * both >= p * (n + size):
                return both, 2.0 * both / (n + size), name
        return None

    def matches(self, unit: set) -> Iterator[tuple[int, float, str]]:
        if self.least <= len(unit) <= self.most:
            yield from filter(None, (self.shared(unit, t) for t in range(len(self.templates))))

    def windows(self, words: list[str], hits: list[int]) -> Iterator[tuple[int, float, str]]:
        """Windows of a template's length that lie so that a bigram of the text meets the same one of the template.

        Enough places of the template's bigrams must lie inside; as no window shares more bigrams than that, none is lost.
        """
        starts: dict[int, set[int]] = {}
        inside: dict[int, list[int]] = {}
        for at in hits:
            for t, q in self.places[words[at], words[at + 1]]:
                starts.setdefault(t, set()).add(at - q)
                seen = inside.setdefault(t, [])
                if not seen or seen[-1] != at:
                    seen.append(at)
        for t, found in inside.items():
            size, _, _, w = self.templates[t]
            for s in starts[t] if len(found) * (200 - self.percent) >= size * self.percent else ():
                near = bisect_left(found, s + len(w) - 1) - bisect_left(found, s)
                if near * (200 - self.percent) >= size * self.percent:
                    match = self.shared(pairs(words[max(s, 0) : s + len(w)]), t)
                    if match:
                        yield match

    def scan(self, text: str) -> tuple[int, str | None, float | None]:
        """(distinct licences, the best one, its coefficient) over lines, blocks between blank lines, the whole text and windows."""
        words = words_of(text)
        hits = [at for at, pair in enumerate(zip(words, words[1:], strict=False)) if pair in self.places]
        if not hits:
            return 0, None, None
        lines = [w for line in text.split("\n") if len(w := words_of(line)) > self.least]
        blocks = [words_of(block) for block in BLANK_LINE.split(text)]
        found: dict[str, tuple[int, float]] = {}
        for unit in [*lines, *blocks, words]:
            for both, dice, name in self.matches(pairs(unit)):
                found[name] = max((both, dice), found.get(name, (0, 0.0)))
        for both, dice, name in self.windows(words, hits):
            found[name] = max((both, dice), found.get(name, (0, 0.0)))
        if not found:
            return 0, None, None
        best = min(found, key=lambda name: (-found[name][0], -found[name][1], name))
        return len(found), best, found[best][1]


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_licences, licence, dice) for every row of ``docs`` (doc_id, text, ...).

    Each line, each block between blank lines, the whole text, and each window of a
    template's length that is aligned with it by some bigram, is compared
    with the templates (name, text) whose sizes allow a coefficient of ``percent``; the number
    of templates is small and they travel with the task.  licence is the one that shares most
    bigrams, then of the highest coefficient, then by name, so that a whole licence goes before a
    short notice inside it; null if there is none.  There is no shuffle.

    Defined cases: null, empty and one-word texts match nothing; a template without two
    words matches nothing; repeated rows are returned each; extra columns are ignored.
    """
    matcher = Matcher(TEMPLATES if templates is None else templates, percent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_gc():
                rows = [matcher.scan(t or "") for t in batch.column("text").to_pylist()]
            n, name, dice = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(name, pa.string()), pa.array(dice, pa.float64())],
                names=["doc_id", "n_licences", "licence", "dice"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, n_licences long, licence string, dice double"
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def _values() -> str:
    return ", ".join("({}, '{}', '{}')".format(i, name, " ".join(text.split()).replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))


_WORDS = "string_split(trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')), ' ')"
_PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
OP1_SQL = f"""
WITH templates(tid, name, t) AS (VALUES {_values()}
), known AS (
    SELECT tid, name, len(w) AS words, {_PAIRS} AS g, list_distinct({_PAIRS}) AS b FROM (SELECT tid, name, {_WORDS} AS w FROM templates)
), places AS (
    SELECT tid, words, len(b) AS size, unnest(g) AS pair, unnest(range(0, len(g))) AS q FROM known
), whole AS (
    SELECT row_number() OVER () AS doc, doc_id, {_PAIRS} AS g FROM (SELECT doc_id, {_WORDS} AS w FROM (SELECT doc_id, text AS t FROM documents)) WHERE len(w) > 1
), seeds AS (
    SELECT d.doc, p.tid, p.words, p.size, d.at, p.q, p.pair
    FROM (SELECT doc, unnest(g) AS pair, unnest(range(0, len(g))) AS at FROM whole) d JOIN places p ON d.pair = p.pair
), starts AS (
    SELECT DISTINCT s.doc, s.tid, s.words, s.at - s.q AS start
    FROM seeds s SEMI JOIN (
        SELECT doc, tid FROM seeds GROUP BY doc, tid, size HAVING count(DISTINCT pair) * {200 - PERCENT} >= size * {PERCENT}
    ) enough ON s.doc = enough.doc AND s.tid = enough.tid
), windows AS (
    SELECT w.doc_id, s.tid, list_distinct(list_slice(w.g, greatest(start, 0) + 1, start + words - 1)) AS b
    FROM starts s JOIN whole w ON s.doc = w.doc
), pieces AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents
    UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents
    UNION ALL SELECT doc_id, text FROM documents
), units AS (
    SELECT DISTINCT doc_id, {_WORDS} AS w FROM pieces
), sets AS (
    SELECT doc_id, NULL::INTEGER AS tid, list_distinct({_PAIRS}) AS b FROM units WHERE len(w) > 1
    UNION ALL SELECT doc_id, tid, b FROM windows
), hits AS (
    SELECT doc_id, name, max(struct_pack(joint := joint, dice := 2.0::DOUBLE * joint / total)) AS m
    FROM (
        SELECT s.doc_id, k.name, len(list_intersect(s.b, k.b)) AS joint, len(s.b) + len(k.b) AS total
        FROM sets s JOIN known k ON len(k.b) * {PERCENT} <= len(s.b) * {200 - PERCENT} AND len(s.b) * {PERCENT} <= len(k.b) * {200 - PERCENT}
        WHERE s.tid IS NULL OR s.tid = k.tid
    ) WHERE 200 * joint >= {PERCENT} * total
    GROUP BY doc_id, name
), best AS (
    SELECT doc_id, count(*) AS n, min(struct_pack(joint := -m.joint, dice := -m.dice, name := name)) AS best FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(b.n, 0) AS n_licences, b.best.name AS licence, -b.best.dice AS dice FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
"""
