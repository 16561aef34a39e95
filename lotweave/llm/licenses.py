"""License scans with DataFrame functions only: sparse TF-IDF cosine to templates, then inheritance along paths.

Units of a file are its lines and blocks of consecutive lines (headers), and its whole text (licence files). Lines without a letter or digit
don't count in blocks. Blocks have 2 to 8 lines around, or 12, 16, 24 or 32 from, a line with an anchor that isn't a function word; a
block between two of the long sizes is met by one of them with some other lines. A unit's TF-IDF vector (1 + ln tf) is compared with those of the
templates; the best one from ``least`` on is what the unit states, ties by name; a bare reservation of rights goes behind any licence that the
file states. Of the long licences (Apache, GPL, LGPL, MPL, CC) titles and headers are templates but not the whole texts: such a text is stated
by its title, and is a licence file only if named like one. A file whose whole text states a licence, or
that is named like a licence file and states one anywhere, is a licence file of its directory. A file that states nothing inherits
from the nearest directory above it that has a licence file (the one with the smallest path, if several).

Only units with an anchor token are weighed: without any anchor no unit can reach ``least``, since the rest of every template's vector is too
short for that. Anchors follow from the templates and ``least``; no text is cut.

Texts of any length are read whole; a very long one is one task's work, since its blocks are made from its own lines. Nulls: a null text is
empty and states nothing; a null path is a file of its own without directories. Repeated rows count each. Ties: equal scores go to the first name, two
licence files of one path to the first name too. An empty table gives an empty result. Only the id, path and text columns are read, whatever other
columns are called.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Passages that headers and licence files share.
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_REST = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_REST = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
UNLICENSE_REST = "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to unlicense.org"
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
#: Names in SPDX tags. MIT's tag and title have "License" once more: 'mit' alone, a common German word, or a tag without a name states nothing.
SPDX = {"GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "LGPL-3.0": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later")} | {x: (x,) for x in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "MPL-2.0", "Unlicense")} | {"MIT": ("MIT License",)}
#: Lines of a block that may start anywhere, and that starts at a line with an anchor.
BLOCKS, LONG_BLOCKS = range(2, 9), (12, 16, 24, 32)
#: Fixed value: what a bare reservation of rights states; a licence that the file also states goes before it.
RESERVED = "Proprietary"
#: Short statements, headers, titles and short full texts of common licences, as their stewards publish them.
STATEMENTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "This source code is licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This source code is licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Frequencies follow from the statements alone, so that headers and texts added here don't make other words weigh less.
TEMPLATES = [
    *STATEMENTS,
    (RESERVED, "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {x}") for name, ids in SPDX.items() for x in ids),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", f"{BSD_HEAD} {BSD_TWO} {BSD_REST}"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", f"{BSD_HEAD} {BSD_TWO} {BSD_THIRD} {BSD_REST}"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", GNU.format("General Public License", 2)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", GNU.format("General Public License", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", GNU.format("Lesser General Public License", 3)),
    ("MIT", "License: The MIT License"),
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {MIT_REST}"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", f"This is free and unencumbered software released into the public domain. {UNLICENSE_REST}"),
]
#: English function words, which are anchors last.
COMMON = "a all an and any are as at be by do for from how if in into is it mit no not of on or our out such that the their this to under use was we with without work you".split()
TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"
MAX_BROADCAST_DIRS = 200_000
TEXTS_PER_TASK, MOST_TASKS = 1024, 20_000


class Space:
    """Inverse document frequencies and template vectors."""

    def __init__(self, templates: Sequence[tuple[str, str]], least: float):
        import re

        bags = [Counter(re.findall(TOKEN, text.lower())) for _, text in templates]
        base = [bag for pair, bag in zip(templates, bags, strict=True) if pair in STATEMENTS] or bags
        n, df = len(base), Counter(t for bag in base for t in bag)
        self.unknown = math.log(1 + n) + 1
        self.idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for bag in bags for t in bag}
        self.names = [name for name, _ in templates]
        self.vectors = []
        for bag in bags:
            v = {t: (1 + math.log(c)) * self.idf[t] for t, c in bag.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.vectors.append({t: x / norm for t, x in v.items()})
        # A unit without anchors reaches at most the length of a template's vector without them.
        self.anchors: set[str] = set()
        for v in self.vectors:
            rest = 1.0 - sum(v[t] ** 2 for t in self.anchors & v.keys())
            for t in sorted(v.keys() - self.anchors, key=lambda t: (t in COMMON, -self.idf[t], t)):
                if rest < least**2 - 1e-9:
                    break
                self.anchors.add(t)
                rest -= v[t] ** 2


def _any_of(words: Sequence[str]) -> str:
    """A pattern for one of ``words`` as a whole, by common beginnings: a place in a text is compared with one branch only."""

    def branch(rest: list[str]) -> str:
        by: dict[str, list[str]] = {}
        for w in rest:
            by.setdefault(w[:1], []).append(w[1:])
        parts = [("\\." if c == "." else c) + branch(by[c]) for c in sorted(by) if c]
        return "" if not parts else "(?:" + "|".join(parts) + ")" + ("?" if "" in by else "")

    return "(?<![a-z0-9])" + branch(sorted(words)) + "(?![a-z0-9])"


def scan(files: DataFrame, path: Column, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, path, stated, score, is_licence_file, inherited_from, licence, how) for every row of ``files``.

    ``how`` is stated, inherited or none; ``inherited_from`` is a directory, '' for the root.
    """
    spark = files.sparkSession
    space = Space(templates, least)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    anchored, solid = _any_of(space.anchors), _any_of(space.anchors - set(COMMON))
    f = files.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), path.cast("string").alias("path"), F.lower(text).alias("text"))
    f = f.withColumn("text", F.when(F.col("text").rlike(anchored), F.col("text"))).withColumn("some", F.col("text").isNotNull())
    f = shared.staged(f, "licence-texts")

    # All that follows is grouped by row and more, so dealing the texts by row once spares the shuffles of their tokens. A text's blocks take far
    # longer than its bytes let expect, so the number of tasks follows the texts.
    tasks = min(MOST_TASKS, max(1, -(-f.filter("some").count() // TEXTS_PER_TASK)))
    g = f.filter("some").select("row", "text").repartition(tasks, "row").withColumn("lines", F.filter(F.split("text", r"\r\n|\n|\r", -1), lambda x: x.rlike("[a-z0-9]")))
    g = g.withColumn("at", F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(solid), i)), lambda i: i.isNotNull()))
    n_lines = F.size("lines")
    block = lambda i, n: F.struct(i.cast("int").alias("i"), n.cast("int").alias("n"))
    fits = lambda sizes: F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n <= n_lines)
    around = lambda i: F.flatten(F.transform(fits(BLOCKS), lambda n: F.transform(F.sequence(F.greatest(i - n + 1, F.lit(0)), F.least(i, n_lines - n)), lambda x: block(x, n))))
    ahead = lambda i: F.transform(F.array(*[F.lit(n) for n in LONG_BLOCKS]), lambda n: block(i, F.least(n, n_lines - i)))
    spans = F.array_distinct(F.flatten(F.transform("at", lambda i: F.concat(around(i), ahead(i)))))
    blocks = F.transform(F.filter(spans, lambda b: b["n"] > 1), lambda b: F.array_join(F.slice("lines", b["i"] + 1, b["n"]), "\n"))
    lines = F.filter("lines", lambda x: x.rlike(anchored))
    units = g.select("row", F.posexplode(F.concat(F.array("text"), lines, blocks)).alias("unit", "text"))
    tokens = units.select("row", "unit", F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("token"))
    tf = tokens.groupBy("row", "unit", "token").agg(F.count(F.lit(1)).alias("tf"))
    slots = ", ".join(f"w{i} double" for i in range(len(templates)))
    vocabulary = [(t, idf, *[v.get(t, 0.0) for v in space.vectors]) for t, idf in sorted(space.idf.items())]
    vocab = spark.createDataFrame(vocabulary, f"token string, idf double, {slots}")  # as large as the templates
    weighed = tf.join(F.broadcast(vocab), "token", "left").withColumn("x", (1 + F.log("tf")) * F.coalesce("idf", F.lit(space.unknown)))
    sums = [F.sum(F.col("x") * F.coalesce(f"w{i}", F.lit(0.0))).alias(f"d{i}") for i in range(len(templates))]
    dots = weighed.groupBy("row", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), *sums)
    each = F.array(*[F.struct((-F.round(F.col(f"d{i}") / F.col("norm"), 9)).alias("s"), F.lit(name).alias("licence")) for i, name in enumerate(space.names)])
    best = dots.select("row", "unit", F.array_min(each).alias("b")).filter(F.col("b.s") <= -least)
    best = best.select("row", "unit", F.struct((F.col("b.licence") == RESERVED).alias("last"), "b.s", "b.licence").alias("best"))
    said = best.groupBy("row").agg(F.min("best").alias("best"), F.max(F.col("unit") == 0).alias("whole"))

    slash = F.coalesce(F.col("path"), F.lit(""))
    found = f.select("row", "id", "path").join(said, "row", "left")
    name = F.substring_index(slash, "/", -1)
    found = found.select(
        "id", "path", F.when(F.instr(slash, "/") > 0, F.regexp_replace(slash, "/[^/]*$", "")).otherwise("").alias("dir"), F.col("best.licence").alias("stated"),
        F.coalesce(-F.col("best.s"), F.lit(0.0)).alias("score"), F.coalesce(F.col("whole") | (F.col("best").isNotNull() & name.rlike(LICENCE_FILE)), F.lit(False)).alias("is_licence_file"),
    )
    found = shared.staged(found, "licence-found")

    holders = found.filter("is_licence_file AND path IS NOT NULL").groupBy(F.col("dir").alias("at")).agg(F.min_by("stated", F.struct("path", "stated")).alias("given"))
    dirs = found.filter("path IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))
    ups = dirs.select("dir", F.posexplode(above).alias("depth", "at"))
    nearest = ups.join(holders, "at").groupBy("dir").agg(F.max_by(F.struct("at", "given"), "depth").alias("near"))
    out = found.join(shared.small_enough(shared.staged(nearest, "licence-dirs"), MAX_BROADCAST_DIRS), "dir", "left")
    inherits = F.col("stated").isNull() & F.col("near").isNotNull() & F.col("path").isNotNull()
    return out.select(
        "id", "path", "stated", "score", "is_licence_file", F.when(inherits, F.col("near.at")).alias("inherited_from"),
        F.coalesce("stated", F.when(inherits, F.col("near.given"))).alias("licence"),
        F.when(F.col("stated").isNotNull(), "stated").when(inherits, "inherited").otherwise("none").alias("how"),
    )
