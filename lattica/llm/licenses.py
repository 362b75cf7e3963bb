"""License scans, in DataFrame functions only.

MinHash over overlapping windows of word shingles retrieves templates, and the share of a
template's shingles in the text around the window verifies them. Templates of at least
2 * WINDOW - 1 shingles, whole license texts, are met by windows of WINDOW; shorter ones, notices, by
windows of one shingle, whose MinHash is the shingle itself, so they are not lost among other words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a shingle, shingles in a window, and how far windows of a document lie apart; a template has one at each shingle.
SHINGLE, WINDOW, STEP = 5, 16, 4


def bands_for(similarity: float, probability: float) -> int:
    """Bands of one MinHash each, in one of which windows of this Jaccard similarity meet with the probability."""
    return math.ceil(math.log(1 - probability) / math.log(1 - similarity))


#: Bands, each with a hash function of its own. A changed word leaves 11 of a window's 16 shingles, a similarity
#: of 0.52, and there are several windows to a text.
BANDS = tuple(range(bands_for(0.5, 0.98)))

#: Notices by which texts name their license.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}


#: Texts of licenses, without the holder's line.
TEXTS = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
        notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-3-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
        prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
        TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
        ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
        DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use
        of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
        software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
        and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
        the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a
        copy of the GNU General Public License along with this program.""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}


def shingles(text: Column) -> Column:
    """Hashes of the runs of SHINGLE words, in order; words are letters and digits in lower case. Of a
    shorter text, the hash of all its words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - SHINGLE))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))

    # the word hashes are an argument of a lambda, so that they are made once
    return F.element_at(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), hashed), 1)


def _minima(hashes: Column, starts: Column) -> list[Column]:
    """For each band the smallest hash of the windows that begin at starts."""

    def of(band: int) -> Column:
        held = F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))
        return F.transform(F.array(held), lambda m: F.transform(starts, lambda i: F.array_min(F.slice(m, i, F.lit(WINDOW)))))

    return [F.element_at(of(b), 1) for b in BANDS]


def _starts(hashes: Column, step: int) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes) - (WINDOW - 1)), F.lit(step))


def prepared(templates: DataFrame) -> list[dict]:
    """Templates (name, text) with their shingles and window minima; a library of bounded size, which becomes constants of the plan."""
    rows = templates.select("name", shingles(F.col("text")).alias("hashes")).where("name IS NOT NULL")
    rows = rows.select("name", "hashes", *[m.alias(f"band{i}") for i, m in enumerate(_minima(F.col("hashes"), _starts(F.col("hashes"), 1)))])
    return [r.asDict() for r in rows.orderBy("name").collect()]


def _constant(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def license_matches(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """(doc_id, license, containment, position): one row for each document and template found in it.

    containment is the share of the template's distinct shingles in the text around the best window,
    at least `similarity`; position is the first such window's first shingle, from 0, the earliest among
    equals. Null and empty texts, and texts shorter than a shingle unless a template is as short, match
    nothing; texts of any length are read whole; null templates are ignored; null ids and repeated rows
    pass through as rows of their own; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    given = prepared(templates if templates is not None else spark.createDataFrame([*TEMPLATES.items(), *TEXTS.items()], "name string, text string"))
    long, short = ([t for t in given if (len(t["hashes"]) >= 2 * WINDOW - 1) == k] for k in (True, False))
    # explode of one element: a filter on a column made so isn't pushed below it, where it would be made again for each use
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.array(shingles(F.col(text_col).cast("string")))).alias("hashes"))
    # a window can only have a template window's MinHash if it holds the shingle that gives it: texts without any such shingle need no windows
    rows = rows.where(F.arrays_overlap("hashes", _constant(sorted({h for t in given for h in t["hashes"]}))))
    bands = _minima(F.col("hashes"), _starts(F.col("hashes"), STEP)) if long else []
    if bands:
        rows = rows.select("doc_id", "hashes", F.explode(F.array(F.struct(*[m.alias(f"band{i}") for i, m in enumerate(bands)]))).alias("b")).select("doc_id", "hashes", "b.*")
    met = [F.arrays_overlap(f"band{i}", _constant(sorted({v for t in long for v in t[f"band{i}"]}))) for i in range(len(bands))]
    met.append(F.arrays_overlap("hashes", _constant(sorted({v for t in short for v in t["hashes"]}))))
    any_met = met[0]
    for m in met[1:]:
        any_met = any_met | m
    rows = rows.where(any_met)

    found = []
    for t in given:
        size, own = len(set(t["hashes"])), _constant(t["hashes"])
        if t in long:
            hits = F.flatten(F.array(*[F.transform(_places(f"band{i}", t[f"band{i}"]), lambda p: p * STEP) for i in range(len(bands))]))
        else:
            hits = _places("hashes", t["hashes"])
        found.append(_verified(t["name"], hits, own, size, len(t["hashes"]), similarity))
    best = F.filter(F.array(*found), lambda x: x.isNotNull())
    return rows.select("doc_id", F.explode(best).alias("m")).select("doc_id", "m.license", "m.containment", "m.position")


def _places(array: str, values: list[int]) -> Column:
    """Places, from 0, where the array holds one of the values."""
    wanted = _constant(sorted(set(values)))
    return F.filter(F.transform(array, lambda x, i: F.when(F.array_contains(wanted, x), i)), lambda i: i.isNotNull())


def _verified(name: str, hits: Column, own: Column, size: int, length: int, similarity: float) -> Column:
    """The best place of a template in a document, or null."""

    def scored(place: Column) -> Column:
        start = F.greatest(F.lit(1), place + 1 - (length - 1))
        around = F.slice(F.col("hashes"), start, F.lit(2 * length + WINDOW))
        return F.struct((F.size(F.array_intersect(own, around)) / F.lit(size)).alias("containment"), (-place).alias("place"))

    top = F.array_max(F.transform(F.array_distinct(hits), scored))
    out = F.struct(F.lit(name).alias("license"), top["containment"].alias("containment"), (-top["place"]).cast("int").alias("position"))
    return F.when(top["containment"] >= similarity, out)
