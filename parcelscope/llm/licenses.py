"""License scans: normalised text against licence templates by Dice coefficient over word bigrams.

The units compared are the lines of a text, its paragraphs and the whole, and, for licences inside
other text, stretches of words that begin and end with a bigram of the template. A unit of n bigrams
can reach a Dice coefficient t with a template of m only if n lies between m * t / (2 - t) and
m * (2 - t) / t, so most templates are pruned by size, and units that no size fits are not looked
at. An index from bigram to templates gives the shared bigrams of the rest; stretches are looked for
only where a template has as many bigrams close together as the least size needs, and over all
their beginnings and ends within the bounds. Each document is scanned on its own: there is no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_DICE = 0.8
_WORD = re.compile(r"[^\W_]+")

# Public licence texts and the notices that name them. Holders and years are left out.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_GPL_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
General Public License as published by the Free Software Foundation, either version {version} of the License, or (at
your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}
General Public License for more details. You should have received a copy of the GNU {name} General Public License
along with this program. If not, see https://www.gnu.org/licenses/."""
_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""


def templates() -> list[tuple[str, str]]:
    """(licence, template text): the texts of the short licences, the file headers of the long ones, and
    notices. Notices come in the usual phrasings, and close versions have notices of their own, so that the nearest one wins."""
    found = [
        ("MIT", _MIT_GRANT), ("MIT", _MIT_WARRANTY), ("MIT", f"MIT License {_MIT_GRANT} {_MIT_WARRANTY}"),
        ("ISC", _ISC),
        ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_WARRANTY}"),
        ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_NAMES} {_BSD_WARRANTY}"),
        ("Apache-2.0", _APACHE_HEADER), ("MPL-2.0", _MPL_HEADER), ("Unlicense", _UNLICENSE),
    ]
    named = [("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License")]
    named += [(f"Apache-{v}", f"Apache License, Version {v}") for v in ("1.1", "2.0")]
    named += [("MPL-2.0", "Mozilla Public License, Version 2.0")]
    for (short, name), version in product([("GPL", ""), ("LGPL", "Lesser "), ("AGPL", "Affero ")], ("2", "2.1", "3")):
        label = f"{short}-{version if '.' in version else version + '.0'}"
        named.append((label, f"GNU {name}General Public License, version {version}"))
        found.append((label, _GPL_HEADER.format(name=name.strip(), version=version)))
    for terms, version in product(("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"), ("2.0", "3.0", "4.0")):
        named.append((f"CC-{terms}-{version}", f"CC {terms} {version}"))
    for label, name in named:
        the = "" if label.startswith("CC") else "the "
        for phrase in ("Licensed under", "Released under", "This work is licensed under", "This software is released under", "Distributed under"):
            found.append((label, f"{phrase} {the}{name}"))
    return found


def bigrams(text: str) -> list[tuple[str, str]]:
    words = _WORD.findall(text.lower())
    return list(zip(words, words[1:]))


class Templates:
    """The templates' bigram counts, and an index from bigram to the templates that have it."""

    def __init__(self, texts: list[tuple[str, str]], least: float):
        self.least = least
        self.names = [name for name, _ in texts]
        self.counts = counts = [Counter(bigrams(text)) for _, text in texts]
        self.sizes = [sum(c.values()) for c in counts]
        self.low = [m * least / (2 - least) for m in self.sizes]
        self.high = [m * (2 - least) / least for m in self.sizes]
        self.smallest, self.largest = min(self.low), max(self.high)
        self.index: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for t, own in enumerate(counts):
            for pair, n in own.items():
                self.index[pair].append((t, n))
        self.index = dict(self.index)

    def compare(self, words: list[str]) -> dict[str, float]:
        """Per licence the best Dice coefficient of the unit, those that reach the least one."""
        size = len(words) - 1
        if not self.smallest <= size <= self.largest:
            return {}
        index = self.index
        hits = [pair for pair in zip(words, words[1:]) if pair in index]
        if 2 * len(hits) < self.least * size:  # a template would have to be smaller than its overlap
            return {}
        shared: dict[int, int] = defaultdict(int)
        for pair, n in Counter(hits).items():
            for t, m in index[pair]:
                if self.low[t] <= size <= self.high[t]:
                    shared[t] += min(n, m)
        best: dict[str, float] = {}
        for t, n in shared.items():
            dice = 2 * n / (size + self.sizes[t])
            if dice >= max(self.least, best.get(self.names[t], 0.0)):
                best[self.names[t]] = dice
        top = max(best.values(), default=0.0)
        return {name: dice for name, dice in best.items() if dice == top}

    def scan(self, text: str) -> dict[str, tuple[float, int, int]]:
        """Per licence the best unit as (Dice, start, end), the first of equals; of one unit only
        the nearest licence counts."""
        found: dict[str, tuple[float, int, int]] = {}

        def look(words: list[str], start: int, end: int) -> None:
            for name, dice in self.compare(words).items():
                if dice > found.get(name, (0.0,))[0]:
                    found[name] = (dice, start, end)

        everything: list[str] = []
        flat: list[str] = []
        block: list[str] = []
        at = block_start = lines = blocks = 0
        for line in [*text.split("\n"), ""]:
            words = _WORD.findall(line.lower())
            if words:
                flat += words
                look(words, at, at + len(line))
                if not block:
                    block_start = at
                block += words
                block_end = at + len(line)
                lines += 1
            elif block:
                if lines > 1:
                    look(block, block_start, block_end)
                if len(everything) <= self.largest + 1:
                    everything += block
                block, lines, blocks = [], 0, blocks + 1
            at += len(line) + 1
        if blocks > 1:
            look(everything, 0, len(text))
        for name, dice, start, end in self.stretches(text, flat, found):
            if dice > found.get(name, (0.0,))[0]:
                found[name] = (dice, start, end)
        return found

    def stretches(
        self, text: str, words: list[str], known: dict[str, tuple[float, int, int]]
    ) -> list[tuple[str, float, int, int]]:
        """The best stretch of the text's words for each template, across lines and paragraphs: (name, Dice,
        start, end), of overlapping ones the nearest. A licence that a line, a paragraph or the whole
        gave in full is not looked for again."""
        index = self.index
        hits = [i for i, pair in enumerate(zip(words, words[1:])) if pair in index]
        if len(hits) < self.smallest:
            return []
        places: dict[int, list[int]] = defaultdict(list)
        for i in hits:
            for t, _ in index[words[i], words[i + 1]]:
                places[t].append(i)
        found = []
        for t, at in places.items():
            needed = self.low[t] - 1e-9  # the least size is all shared
            if len(at) >= needed and known.get(self.names[t], (0.0,))[0] < 1.0:
                found += [(dice, -(b - a), a, b, self.names[t]) for dice, a, b in self._best(t, at, words)]
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        taken: list[tuple[int, int]] = []
        out = []
        for dice, _, a, b, name in sorted(found, key=lambda x: (-x[0], x[1], x[2:])):
            if all(b < x or y < a for x, y in taken):
                taken.append((a, b))
                out.append((name, dice, spans[a][0], spans[b + 1][1]))
        whole = [(start, end, dice, name) for name, (dice, start, end) in known.items()]
        # what a unit gave already stands, unless the stretch in it is nearer to its own template
        return [
            (name, dice, start, end) for name, dice, start, end in out
            if not any(s < end and start < e and (d > dice or d == dice and n != name) for s, e, d, n in whole)
        ]

    def _best(self, t: int, at: list[int], words: list[str]) -> list[tuple[float, int, int]]:
        """Per run of close bigrams of template ``t``, at places ``at``, the best (Dice, first, last) stretch."""
        own, size, longest = self.counts[t], self.sizes[t], int(self.high[t] + 1e-9)
        needed = math.ceil(self.low[t] - 1e-9)
        best: list[tuple[float, int, int]] = []
        # bigrams in reach of the beginning, and how many of them the template has, too
        inside: dict[tuple[str, str], int] = defaultdict(int)
        until = in_both = 0
        for k, begin in enumerate(at):
            while until < len(at) and at[until] - begin < longest:
                pair = (words[at[until]], words[at[until] + 1])
                inside[pair] += 1
                in_both += inside[pair] <= own[pair]
                until += 1
            enough, pair = in_both >= needed, (words[begin], words[begin + 1])
            in_both -= inside[pair] <= own[pair]
            inside[pair] -= 1
            if not enough:
                continue
            left, shared, top = dict(own), 0, None
            for end in islice(at, k, None):
                if end - begin >= longest:
                    break
                pair = (words[end], words[end + 1])
                if left[pair]:
                    left[pair] -= 1
                    shared += 1
                dice = 2 * shared / (end - begin + 1 + size)
                if dice >= self.least and (top is None or dice > top[0]):
                    top = (dice, begin, end)
            if top is not None:
                if best and best[-1][2] >= top[1]:  # overlaps the one before
                    best[-1] = max(best[-1], top, key=lambda x: (x[0], x[1] - x[2], -x[1]))
                else:
                    best.append(top)
        return best


@lru_cache(maxsize=4)
def prepared(texts: tuple[tuple[str, str], ...], least: float) -> Templates:
    return Templates(list(texts), least)


def licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST_DICE, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, license, dice, start, end): a row per document row and licence found in it.

    ``start`` and ``end`` are code points of the unit that is nearest to a template. Null and empty
    texts give no rows, repeated rows are scanned each, other columns are ignored. ``texts`` are
    (licence, template) pairs and bounded by what a worker holds; ``templates()`` by default.
    """
    given = tuple(templates() if texts is None else texts)
    source = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text <> ''")
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("license", T.StringType()),
            T.StructField("dice", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = prepared(given, least)
        for batch in batches:
            rows, found = [], []
            for n in range(batch.num_rows):
                for name, hit in sorted(known.scan(batch.column(1)[n].as_py()).items()):
                    rows.append(n)
                    found.append((name, *hit))
            columns = list(zip(*found)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()),
                ],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)
