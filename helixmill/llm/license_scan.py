"""Licence scans: sparse TF-IDF cosine to templates, then inheritance down the directories.

Templates are the customary notices of common licences (made from their names and the usual
phrases), the header notices that licences ask for, and whole licence bodies. A file's segments
are its single lines, its runs of neighbouring paragraphs, and the file as a whole; comment
signs at the beginning of lines are left out. A segment is a vector over terms, weighted by
count and inverse document frequency over all files; terms that no template has share the
weight of a term seen in no file. A file's own licence is the template of highest cosine with
any segment, if that reaches `threshold` ("All rights reserved" only counts where no licence
does). A file is a licence file of its directory if its name says so or its matched segments
make up half of its words.

A cosine of t needs terms with t squared of a template's weight. So every template has a few
telling terms (its rarest, of more than 1 - t**2 together) of which a segment must have one,
and only segments with such a term are scored. A segment must also share a term with the
template that few licences have ("license" alone names none).

Files without a licence of their own take that of the nearest ancestor directory with a
licence file: each directory's licences are one row, directories that hold files are joined
with them level by level (one row a directory and ancestor), and the files then join their
own directory's verdict. What a directory inherits is a row a directory, not a file; the
last join is broadcast only while there are few directories.

Document frequencies are counted over all files, map-side first. Texts are read whole.

Defined results: null and empty texts have no licence of their own; null paths are the root
directory's; equal scores go to the first template by name; several licence files in a
directory: the highest score, then the first name; repeated rows get equal rows; without files
the result is empty. Paths are split at "/"; empty steps don't count. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmill.llm.shared import written

#: Licences and the names that notices call them by.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License", "BSL-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0-1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL-3.0"],
    "ISC": ["ISC License", "ISC"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"],
    "MIT": ["MIT License", "MIT"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
#: The phrases of notices. Those of one word more are for single names only.
PHRASES = [
    "Licensed under the {}", "Licensed under {}", "Released under the {}", "Released under {}", "Distributed under the {}",
    "Distributed under the terms of the {}", "Subject to the terms of the {}", "Available under the {}", "The {}", "{}",
    "This project is licensed under the {}", "This project is licensed under the terms of the {}", "This software is licensed under the {}",
    "This work is licensed under the {}", "This work is licensed under a {}", "This file is licensed under the {}",
    "Released under the {}. See the file LICENSE for details", "Licensed under the {}. See LICENSE in the project root for license information",
    "This project is licensed under the {} - see the LICENSE file for details", "SPDX-License-Identifier: {}", "Dedicated to the public domain under {}",
]
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the
Free Software Foundation, either version {1} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details.
You should have received a copy of the {0} along with this program. If not, see <https://www.gnu.org/licenses/>."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. {}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Licence bodies, header notices and titles of licence files, as their publishers word them.
BODIES = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("""3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.""")),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software
must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("BSL-1.0", """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)"""),
    ("CC0-1.0", """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."""),
    *[(f"{n}-{v}", _GNU.format(f"GNU {x}General Public License", v.split(".0")[0]))
      for n, x, v in (("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0"))],
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Proprietary", "All rights reserved"),
]
TEMPLATES = [(licence, phrase.format(name)) for licence, names in NAMES.items() for name in names for phrase in PHRASES] + BODIES
#: The licence that only counts where no other is found.
LAST = "Proprietary"
THRESHOLD = 0.8
#: Neighbouring paragraphs in one segment, at most: a body has up to four.
RUN = 4
#: Licences that may share a term which names them.
FEW = 6
#: A directory table up to this number of rows is broadcast.
BROADCAST_DIRECTORIES = 50_000
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)([.\-_][^/]*)?$"
_TERM = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_COMMENT = re.compile(r"^[ \t]*(?:(?:#+|//+|/?\*+/?|;+|--+|<!--|%+|\"+|>+)[ \t]*)+|[ \t]*(?:\*+/|-->)[ \t]*$")


def terms(line: str) -> list[str]:
    """Lower-cased runs of letters and digits; dots and hyphens inside stay ("by-nc", "4.0")."""
    return _TERM.findall(line.lower())


def frequencies(files: DataFrame, text_col: str) -> tuple[int, dict[str, int]]:
    """The number of files, and in how many each of the templates' terms occurs."""
    known = frozenset(t for _, x in TEMPLATES for t in terms(x))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(known.intersection(terms(text)))
        names = [*found, ""]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([*found.values(), n], pa.int64())], names=["term", "n"])

    texts = files.select(F.col(text_col).cast("string"))
    rows = texts.mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {t: 0 for t in known} | {r["term"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


class Scanner:
    """Scores segments of files against the templates under given document frequencies."""

    def __init__(self, files: int, counts: dict[str, int], threshold: float = THRESHOLD):
        self.idf = {t: 1 + math.log((1 + files) / (1 + n)) for t, n in counts.items()}
        self.other = 1 + math.log(1 + files)
        self.threshold = threshold
        bags = {(name, tuple(sorted(Counter(terms(x)).items()))) for name, x in TEMPLATES}
        self.templates = [(name, self._unit(dict(bag))) for name, bag in sorted(bags)]
        #: Terms that at most FEW of the licences have in any template.
        licences: dict[str, set[str]] = {}
        for name, vector in self.templates:
            for t in vector:
                licences.setdefault(t, set()).add(name)
        self.own = {t for t, names in licences.items() if len(names) <= FEW}
        #: Row of each known term in the matrix of the templates' weights.
        self.rows = {t: i for i, t in enumerate(sorted({t for _, v in self.templates for t in v}))}
        self.weights = np.zeros((len(self.rows), len(self.templates)))
        self.telling: set[str] = set()
        for i, (_, vector) in enumerate(self.templates):
            for t, w in vector.items():
                self.weights[self.rows[t], i] = w
            mass = 0.0
            for t, w in sorted(vector.items(), key=lambda x: (-self.idf.get(x[0], self.other), -x[1], x[0])):
                self.telling.add(t)
                mass += w * w
                if mass > 1 - threshold * threshold + 1e-9:
                    break

    def _unit(self, counts: dict[str, int]) -> dict[str, float]:
        vector = {t: n * self.idf.get(t, self.other) for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in vector.values()))
        return {t: w / length for t, w in vector.items()} if length else {}

    def segment(self, counts: Counter) -> tuple[str | None, float]:
        """The best template of a bag of terms; LAST counts as less than any licence found."""
        known = {t: n * self.idf.get(t, self.other) for t, n in counts.items() if t in self.rows}
        mass = sum(w * w for w in known.values())
        # The cosine is at most the square root of the known terms' share.
        total = mass + sum((n * self.other) ** 2 for t, n in counts.items() if t not in known)
        if mass < self.threshold * self.threshold * total - 1e-9:
            return None, 0.0
        scores = np.array(list(known.values())) @ self.weights[[self.rows[t] for t in known]] / math.sqrt(total)
        best = None, 0.0
        for i in np.flatnonzero(scores >= self.threshold - 1e-12).tolist():
            if not self.own.isdisjoint(known.keys() & self.templates[i][1].keys()) and better(self.templates[i][0], float(scores[i]), *best):
                best = self.templates[i][0], float(scores[i])
        return best

    def text(self, text: str | None) -> tuple[str | None, float, float]:
        """(licence, score, share of the words in matched segments) of a whole text."""
        if not text or self.telling.isdisjoint(terms(text)):
            return None, 0.0, 0.0
        best, covered = (None, 0.0), set()
        lines = text.split("\n")
        bags = [Counter(terms(_COMMENT.sub("", x))) for x in lines]
        told = np.concatenate(([0], np.cumsum([not self.telling.isdisjoint(x) for x in bags])))
        for begin, end in segments(bags):
            if told[end] == told[begin]:
                continue
            bag = bags[begin] if end - begin == 1 else sum_of(bags[begin:end])
            name, score = self.segment(bag)
            if name:
                covered.update(range(begin, end))
                if better(name, score, *best):
                    best = name, score
        words = sum(len(x.split()) for x in lines)
        return best[0], round(best[1], 9), sum(len(lines[i].split()) for i in covered) / max(1, words)


def sum_of(bags: list[Counter]) -> Counter:
    total = Counter()
    for bag in bags:
        total.update(bag)
    return total


def better(name: str, score: float, than: str | None, its: float) -> bool:
    """Whether a found licence comes before another: any before LAST, the higher score, the name."""
    return than is None or ((name != LAST, round(score, 9)), than) > ((than != LAST, round(its, 9)), name)


def segments(bags: list[Counter]) -> Iterator[tuple[int, int]]:
    """(first line, end) of all segments: lines with terms, runs of up to RUN paragraphs, the file."""
    paragraphs, begin = [], None
    for i, bag in enumerate([*bags, Counter()]):
        if bag:
            yield i, i + 1
            begin = i if begin is None else begin
        elif begin is not None:
            paragraphs.append((begin, i))
            begin = None
    for i in range(len(paragraphs)):
        for j in range(i, min(i + RUN, len(paragraphs))):
            if paragraphs[j][1] - paragraphs[i][0] > 1:
                yield paragraphs[i][0], paragraphs[j][1]
    if len(paragraphs) > RUN:
        yield 0, len(bags)


def scanned(files: DataFrame, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """files with __own (licence of its own), __score and __share."""
    total, counts = frequencies(files, text_col)

    @F.pandas_udf("own string, score double, share double")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(total, counts, threshold)
        for texts in batches:
            yield pd.DataFrame([scanner.text(t) for t in texts], columns=["own", "score", "share"])

    out = files.withColumn("__scan", scan(F.col(text_col).cast("string")))
    return out.select(*files.columns, F.col("__scan.own").alias("__own"), F.col("__scan.score").alias("__score"), F.col("__scan.share").alias("__share"))


def directory(path: Column) -> Column:
    """The path's directory steps, without the file's name."""
    steps = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda x: x != "")
    return F.slice(steps, 1, F.greatest(F.size(steps) - 1, F.lit(0)))


def licences(
    files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, path, licence, score, origin, licence_dir) per file.

    origin: "header", "licence file", "inherited" or null; licence_dir is the directory that
    the licence was inherited from.
    """
    rows = files.select(F.col(id_col), F.col(text_col), path.cast("string").alias("__path"))
    own = written(scanned(rows, text_col, threshold).drop(text_col).withColumn("__dir", F.array_join(directory(F.col("__path")), "/")))
    is_file = F.col("__own").isNotNull() & (F.coalesce(F.col("__path").rlike(LICENCE_NAME), F.lit(False)) | (F.col("__share") >= 0.5))
    best = F.min(F.struct((-F.col("__score")).alias("s"), F.col("__own").alias("name")))
    given = own.filter(is_file).groupBy("__dir").agg(best.alias("b")).select(F.col("__dir").alias("__from"), F.col("b.name").alias("__given"))
    # Each directory in use with its ancestors, itself included; the longest with a licence wins.
    used = own.select("__dir").distinct()
    steps = F.split("__dir", "/")
    depth = F.when(F.col("__dir") == "", F.lit(0)).otherwise(F.size(steps))
    above = used.select("__dir", F.explode(F.sequence(F.lit(0), depth)).alias("__depth")).withColumn(
        "__from", F.array_join(F.slice(steps, 1, F.col("__depth")), "/")
    )
    nearest = above.join(given, "__from").groupBy("__dir").agg(F.max(F.struct("__depth", "__from", "__given")).alias("n"))
    table = written(nearest.select("__dir", F.col("n.__from").alias("__from"), F.col("n.__given").alias("__given")))
    table = F.broadcast(table) if table.count() <= BROADCAST_DIRECTORIES else table
    joined = own.withColumn("__is_file", is_file).join(table, "__dir", "left")
    origin = (
        F.when(F.col("__is_file"), "licence file").when(F.col("__own").isNotNull(), "header").when(F.col("__given").isNotNull(), "inherited")
    )
    inherits = F.col("__own").isNull() & F.col("__given").isNotNull()
    return joined.select(
        id_col, F.col("__path").alias("path"), F.coalesce("__own", "__given").alias("licence"),
        F.when(F.col("__own").isNotNull(), F.col("__score")).alias("score"), origin.alias("origin"),
        F.when(inherits, F.col("__from")).alias("licence_dir"),
    )
