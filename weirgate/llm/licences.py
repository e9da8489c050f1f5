"""License scan: sparse TF-IDF cosine of headers and licence files to templates,
then inheritance from the nearest ancestor directory.

Units are the lines of every file, its paragraphs of two lines or more (runs of
lines that hold a word, so wrapped headers behind comment marks are one unit), and
for licence files also the whole text.  Terms are folded words.  A template
term's document frequency is counted over the lines of all files; terms of no
template weigh as if they occurred once.  A prefix bound keeps the join sparse:
with a template's terms ordered by rarity, a unit that shares none of the first
ones, up to where the rest weighs less than the threshold, cannot reach it, so only
files, and in them units, with such a term are compared.

A file has the licence of its best unit at or over the threshold.  A file
without takes that of the nearest directory above it that holds a licence file
with one: directories are joined to their ancestors by path, level by level of
the path's own length, and the deepest match wins.

Templates are a parameter of bounded size (`MOST_TERMS` terms in all).  All
steps are DataFrame functions.

Defined results: null or empty texts have no licence of their own; a null path
inherits none; ties go to the whole file, then to the first paragraph, then to
the first line, then to the alphabetically first licence; repeated rows get equal
results; extra columns are ignored; texts are compared whole, however long.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

THRESHOLD = 0.75
MOST_TERMS = 5000
#: Places of units: the whole file, paragraphs from here on, lines from 0.
WHOLE, PARAGRAPHS = -(1 << 30), -(1 << 29)

#: Texts of public licences, their opening paragraphs and their customary headers.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_OPEN = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU_TITLE = "GNU {name} GENERAL PUBLIC LICENSE Version {v}, {date} Copyright (C) {year} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_GNU_HEAD = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
_GNU_COPY = "You should have received a copy of the GNU {name} General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."


def _gnu(name: str, v: str, date: str, year: str) -> tuple[str, ...]:
    return tuple(" ".join(x.format(name=name, v=v, date=date, year=year).split()) for x in (_GNU_TITLE, _GNU_HEAD, _GNU_COPY))


TEMPLATES = {
    "MIT": ("Released under the MIT License.", "MIT License", _MIT_GRANT, " ".join((_MIT_GRANT, _MIT_NOTICE, _AS_IS)), "SPDX-License-Identifier: MIT"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", *_gnu("", "3", "29 June 2007", "2007"), "SPDX-License-Identifier: GPL-3.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", *_gnu("", "2", "June 1991", "1989, 1991")[:2], "SPDX-License-Identifier: GPL-2.0"),
    "LGPL-3.0": (*_gnu("Lesser", "3", "29 June 2007", "2007"), "SPDX-License-Identifier: LGPL-3.0"),
    "AGPL-3.0": (*_gnu("Affero", "3", "19 November 2007", "2007"), "SPDX-License-Identifier: AGPL-3.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    "CC0-1.0": ("CC0 1.0 Universal", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide. This work is distributed without any warranty."),
    "BSD-3-Clause": (f"{_BSD_OPEN} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES}", " ".join((_BSD_OPEN, _BSD_SOURCE, _BSD_BINARY, _BSD_NAMES, _BSD_AS_IS)), _BSD_NAMES, "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": (f"{_BSD_OPEN} {_BSD_SOURCE} {_BSD_BINARY}", " ".join((_BSD_OPEN, _BSD_SOURCE, _BSD_BINARY, _BSD_AS_IS)), "BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "SPDX-License-Identifier: ISC",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "SPDX-License-Identifier: Unlicense"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"),
}

TERM = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"


#: What lies between paragraphs: lines without a letter or digit.
GAP = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1)


def _split(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", text.lower())


def _vectors(templates: dict[str, tuple[str, ...]], idf: dict[str, float], threshold: float) -> tuple[list[tuple[str, dict[str, float]]], set[str]]:
    """(licence, unit vector) of each template, and the terms one of which a unit has to share."""
    vectors, needed = [], set()
    for name, texts in sorted(templates.items()):
        for text in texts:
            raw = {t: n * idf[t] for t, n in Counter(_split(text)).items()}
            size = math.sqrt(sum(w * w for w in raw.values()))
            vector = {t: w / size for t, w in raw.items()}
            vectors.append((name, vector))
            rest = 1.0
            for t, w in sorted(vector.items(), key=lambda x: (-idf[x[0]], x[0])):
                if math.sqrt(max(0.0, rest)) < threshold - 1e-9:
                    break
                needed.add(t)
                rest -= w * w
    return vectors, needed


def scan(files: DataFrame, licence_file: Column, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, licence, how (own, inherited or none), score of an own
    licence, and the directory that an inherited one comes from."""
    spark = files.sparkSession
    vocabulary = sorted({t for texts in templates.values() for x in texts for t in _split(x)})
    if len(vocabulary) > MOST_TERMS:
        raise ValueError(f"templates have {len(vocabulary)} terms; at most {MOST_TERMS} are supported")
    rows = files.select(
        F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"), F.coalesce(licence_file, F.lit(False)).alias("named"), F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text_col), F.lit("")))).alias("key")
    )
    told = rows.where(F.col("text") != "")
    held = F.posexplode(F.split("text", "\n"))
    # one aggregate: the empty term stands for the line itself
    counted = told.select(held.alias("line", "unit")).select(terms_of(F.col("unit")).alias("terms")).where(F.size("terms") > 0)
    counted = counted.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct("terms"))).alias("term")).where(F.col("term").isin("", *vocabulary)).groupBy("term").count()
    often = {r["term"]: r["count"] for r in counted.collect()}  # at most MOST_TERMS + 1 rows
    n = often.get("", 0)
    idf = {t: math.log((1 + n) / (1 + often.get(t, 0))) + 1 for t in vocabulary}
    most = math.log((1 + n) / 2) + 1
    vectors, needed = _vectors(templates, idf, threshold)

    telling = lambda terms: F.exists(terms, lambda t: t.isin(*sorted(needed)))
    near = shared.durable(told.select("key", "text", "named").where(telling(terms_of(F.col("text")))), "telling")  # files that hold such a term at all
    part = lambda c: near.select("key", c.alias("line", "unit"))
    lines = part(held)
    paragraphs = part(F.posexplode(F.split("text", GAP))).where(F.col("unit").contains("\n")).withColumn("line", F.col("line") + F.lit(PARAGRAPHS))
    whole = near.where("named").select("key", F.lit(WHOLE).alias("line"), F.col("text").alias("unit"))
    units = lines.unionByName(paragraphs).unionByName(whole)
    close = units.select("key", "line", terms_of(F.col("unit")).alias("terms")).where(telling(F.col("terms")))
    tf = close.select("key", "line", F.explode("terms").alias("term")).groupBy("key", "line", "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    table = spark.createDataFrame([(t, idf[t], [v.get(t, 0.0) for _, v in vectors]) for t in vocabulary], "term string, idf double, w array<double>")
    weighed = tf.join(F.broadcast(table), "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(most)))
    sums = weighed.groupBy("key", "line").agg(F.sum(F.col("x") * F.col("x")).alias("norm"), *(F.sum(F.col("x") * F.coalesce(F.col("w")[i], F.lit(0.0))).alias(f"t{i}") for i in range(len(vectors))))
    scores = F.array(*(F.struct(F.round(F.col(f"t{i}") / F.sqrt("norm"), 9).alias("score"), F.lit(name).alias("licence")) for i, (name, _) in enumerate(vectors)))
    best = sums.select("key", "line", F.explode(scores).alias("s")).where(F.col("s.score") >= threshold)
    # of equal scores the first place wins
    order = F.struct(F.col("s.score").alias("score"), (-F.col("line")).alias("line"))
    own = best.groupBy("key", F.col("s.licence").alias("licence")).agg(F.max(order).alias("o")).groupBy("key").agg(F.min(F.struct((-F.col("o.score")).alias("s"), (-F.col("o.line")).alias("l"), "licence")).alias("b"))
    own = own.select("key", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"))
    found = rows.select("doc_id", "path", "named", "key", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), F.lit(""))).alias("dir"))
    found = found.join(own, "key", "left")

    given = found.where(F.col("named") & F.col("licence").isNotNull() & F.col("dir").isNotNull()).groupBy(F.col("dir").alias("above")).agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("g")).select("above", F.col("g.licence").alias("given"))
    parts = F.split("dir", "/")
    ancestors = found.where("licence is null and dir is not null").select("dir").distinct().select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
    ancestors = ancestors.select("dir", "depth", F.when(F.col("depth") > 0, F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")).otherwise(F.lit("")).alias("above"))
    nearest = ancestors.join(given, "above").groupBy("dir").agg(F.max(F.struct("depth", "given", "above")).alias("n")).select("dir", F.col("n.given").alias("given"), F.col("n.above").alias("above"))
    out = found.join(nearest, "dir", "left")
    bare = F.col("licence").isNull()
    return out.select(
        "doc_id", "path", F.coalesce("licence", "given").alias("licence"),
        F.when(~bare, F.lit("own")).when(F.col("given").isNotNull(), F.lit("inherited")).otherwise(F.lit("none")).alias("how"),
        "score", F.when(bare, F.col("above")).alias("from_dir"),
    )
