"""Licence scan: parts of a text compared with licence templates by Dice's coefficient over word bigrams.

Parts are the lines, the blocks between blank lines, the whole text, and runs of lines (so of blocks, too). A part and a template are normalised to words of
a to z and 0 to 9. Dice's coefficient 2|A and B| / (|A| + |B|) is bounded by the sizes of the two sets, so a part is compared
only with templates of about its size, and only if it has enough bigrams that occur in any template. Everything is a
Spark SQL expression, within the row.

Runs are formed only for templates of which the text as a whole has enough bigrams. A run starts and ends with a line that
has a bigram of the template: without other lines at its ends the coefficient is no smaller.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, without

PERCENT = 80  # least coefficient of a match
OUTPUT = ["licences", "best_licence", "best_dice"]

# Notices and texts of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the MIT License, see the LICENSE file for details"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is released under the GNU General Public License, version 3"),
    ("GPL-3.0", "Distributed under the terms of the GNU General Public License, version 3"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("LicenseRef-Proprietary", "All rights reserved"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    words = re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _parts(text: Column) -> Column:
    lines, blocks = F.split(text, "\n", -1), F.split(text, r"\n[ \t\r]*\n", -1)
    return F.array_distinct(F.concat(lines, blocks, F.array(text)))


SPAN = 4  # bigrams in a run, repeated ones too, for each bigram of the template; 1.5 distinct ones is the bound of Dice


def _runs(runs: Column, percent: int) -> list:
    """Steps from the text's lines, as words, to its matches in runs of two or more lines. Each works on the one struct of
    an array, so that nothing is computed again for each element."""

    def placed(x: Column) -> Column:
        owner = F.flatten(F.transform(x["lines"], lambda w, i: F.array_repeat(i, F.size(w))))
        return F.struct(x["near"].alias("near"), F.flatten(x["lines"]).alias("words"), owner.alias("owner"))

    def bounded(x: Column) -> Column:
        n = F.size(x["words"])
        at = F.sequence(F.lit(0), n - 1)
        owner = lambda k: F.get(x["owner"], k)
        pairs = F.zip_with(F.slice(x["words"], F.lit(1), n - 1), F.slice(x["words"], F.lit(2), n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
        first = F.filter(at, lambda k: (k == 0) | (owner(k) != owner(k - 1)))
        last = F.filter(at, lambda k: (k == n - 1) | (owner(k) != owner(k + 1)))
        return F.struct(x["near"].alias("near"), pairs.alias("pairs"), x["owner"].alias("owner"), first.alias("first"), last.alias("last"))

    def hits(x: Column) -> Column:
        def of(t: Column) -> Column:
            at = F.filter(F.transform(x["pairs"], lambda b, k: F.when(F.array_contains(t["bigrams"], b), k)), lambda k: k.isNotNull())
            return F.struct(t.alias("t"), x["pairs"].alias("pairs"), x["owner"].alias("owner"), x["first"].alias("first"), x["last"].alias("last"), at.alias("at"))

        return F.transform(x["near"], of)

    def ends(x: Column) -> Column:
        starts = F.array_distinct(F.transform(x["at"], lambda k: F.get(x["owner"], k)))
        stops = F.array_distinct(F.transform(x["at"], lambda k: F.get(x["owner"], k + 1)))
        return F.struct(
            x["t"].alias("t"),
            x["pairs"].alias("pairs"),
            F.transform(starts, lambda i: F.struct(i.alias("line"), F.get(x["first"], i).alias("at"))).alias("starts"),
            F.transform(stops, lambda j: F.struct(j.alias("line"), F.get(x["last"], j).alias("at"))).alias("stops"),
        )

    def compared(x: Column) -> Column:
        t = x["t"]

        def from_(a: Column) -> Column:
            near = F.filter(x["stops"], lambda z: (z["line"] > a["line"]) & (z["at"] - a["at"] <= SPAN * t["size"]))
            return F.transform(near, lambda z: F.array_distinct(F.slice(x["pairs"], a["at"] + 1, z["at"] - a["at"])))

        counted = F.transform(F.flatten(F.transform(x["starts"], from_)), lambda b: F.struct(F.size(b).alias("size"), F.size(F.array_intersect(b, t["bigrams"])).alias("both")))
        dice = lambda p: F.struct((2.0 * p["both"] / (t["size"] + p["size"])).cast("double").alias("dice"), t["name"].alias("name"), (200 * p["both"] >= percent * (t["size"] + p["size"])).alias("match"))
        return F.filter(F.transform(counted, dice), lambda m: m["match"])

    return [
        lambda: F.transform(runs, placed),
        lambda: F.transform(runs, bounded),
        lambda: F.flatten(F.transform(runs, hits)),
        lambda: F.transform(runs, ends),
        lambda: F.flatten(F.transform(runs, compared)),
    ]


def scan(documents: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Documents with `licences` (names matched by any part, sorted), `best_licence` and `best_dice` (the largest
    coefficient of all parts; a tie goes to the name first in order).

    Runs of lines with over SPAN times the bigrams of a template, repeated ones counted, are not compared with it.
    A null or empty text matches nothing: no names, null for the best. Repeated rows are scanned each; columns named like
    the output are replaced; an empty table gives no rows. Templates with fewer than two words are left out.
    """
    known = [(name, b) for name, t in templates if (b := bigrams_of(t))]
    vocabulary = sorted({b for _, some in known for b in some})
    least = min(len(b) for _, b in known)
    source = without(documents, OUTPUT)
    raw = F.coalesce(quoted(text).cast("string"), F.lit(""))
    literal = F.array(*[F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, b)).alias("bigrams"), F.lit(len(b)).alias("size")) for n, b in known])

    def words(part: Column) -> Column:
        return F.split(F.trim(F.regexp_replace(F.translate(part, UPPER, LOWER), "[^a-z0-9]+", " ")), " ")

    def bigrams(w: Column) -> Column:
        n = F.size(w) - 1
        return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))

    def shared(b: Column) -> Column:
        return F.struct(F.size(b).alias("size"), F.filter(b, lambda x: x.isin(*vocabulary)).alias("known"))

    def matches(part: Column) -> Column:
        def alike(t: Column) -> Column:
            # Neither the smaller set nor the known bigrams of the part can give a larger intersection.
            most = F.least(t["size"], F.size(part["known"]))
            return 200 * most >= percent * (t["size"] + part["size"])

        def compared(t: Column) -> Column:
            both = F.size(F.array_intersect(part["known"], t["bigrams"]))
            return F.struct((2.0 * both / (t["size"] + part["size"])).cast("double").alias("dice"), t["name"].alias("name"), (200 * both >= percent * (t["size"] + part["size"])).alias("match"))

        return F.filter(F.transform(F.filter(literal, alike), compared), lambda m: m["match"])

    def near(whole: Column) -> Column:
        """Templates of which a part of the text can have enough: both >= percent / 200 * (size + both)."""
        enough = lambda t, n: (200 - percent) * n >= percent * t["size"]
        return F.filter(literal, lambda t: enough(t, F.size(whole["known"])) & enough(t, F.size(F.array_intersect(whole["known"], t["bigrams"]))))

    lines = F.filter(F.transform(F.split(raw, "\n", -1), words), lambda w: w[0] != "")
    steps = [
        lambda: F.transform("_parts", words),
        lambda: F.transform("_parts", bigrams),
        lambda: F.transform("_parts", shared),
    ]
    df = source.withColumn("_parts", _parts(raw))
    for step in steps:
        df = df.withColumn("_parts", step())
    # The whole text is the last of the parts.
    df = df.withColumn("_runs", near(F.element_at("_parts", -1)))
    df = df.withColumn("_runs", F.when((F.size("_runs") > 0) & F.contains(raw, F.lit("\n")), F.array(F.struct(F.col("_runs").alias("near"), lines.alias("lines")))))
    for step in _runs(F.col("_runs"), percent):
        df = df.withColumn("_runs", F.when(F.size("_runs") > 0, step()))
    steps = [
        lambda: F.filter("_parts", lambda p: 200 * F.size(p["known"]) >= percent * (p["size"] + least)),
        lambda: F.flatten(F.transform("_parts", matches)),
        lambda: F.when(F.size("_runs") > 0, F.concat("_parts", "_runs")).otherwise(F.col("_parts")),
    ]
    for step in steps:
        df = df.withColumn("_parts", step())
    best = F.array_max(F.transform("_parts", lambda m: m["dice"]))
    names = lambda some: F.array_sort(F.array_distinct(F.transform(some, lambda m: m["name"])))
    return df.withColumn("_best", best).select(
        *[quoted(c) for c in source.columns],
        names(F.col("_parts")).alias("licences"),
        F.get(names(F.filter("_parts", lambda m: m["dice"] == F.col("_best"))), F.lit(0)).alias("best_licence"),
        F.col("_best").alias("best_dice"),
    )


def sql(templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> str:
    """DuckDB SQL for doc_id, n_licences, licences, best_licence and best_dice of the table `documents`."""
    known = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{b}'" for b in found)) for name, t in templates if (found := bigrams_of(t))
    )
    words = f"string_split(trim(regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"""
    WITH templates(name, bigrams) AS (VALUES {known}),
    parts AS (
        SELECT doc_id, unnest(list_distinct(list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '\\n[ \\t\\r]*\\n'), [t]))) AS part
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    ),
    words AS (SELECT doc_id, {words} AS w FROM parts),
    sets AS (
        SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) > 1
    ),
    numbered AS (SELECT row_number() OVER () AS part_id, doc_id, b FROM sets),
    entries AS (SELECT part_id, doc_id, len(b) AS size, unnest(b) AS bigram FROM numbered),
    numbered_templates AS (SELECT row_number() OVER () AS template_id, name, bigrams FROM templates),
    template_entries AS (SELECT template_id, name, len(bigrams) AS t_size, unnest(bigrams) AS bigram FROM numbered_templates),
    compared AS (
        SELECT doc_id, part_id, name, t_size, size, count(*) AS both_sizes
        FROM entries JOIN template_entries USING (bigram) GROUP BY doc_id, part_id, template_id, name, t_size, size
    ),
    matched AS (
        SELECT doc_id, name, 2.0::DOUBLE * both_sizes / (t_size + size) AS dice FROM compared WHERE 200 * both_sizes >= {percent} * (t_size + size)
    ),
    best AS (SELECT doc_id, max(dice) AS best_dice FROM matched GROUP BY doc_id),
    named AS (
        SELECT m.doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, count(DISTINCT name) AS n, min(name) FILTER (dice = best_dice) AS best_licence,
            max(best_dice) AS best_dice
        FROM matched m JOIN best b ON m.doc_id = b.doc_id GROUP BY m.doc_id
    )
    SELECT d.doc_id, coalesce(n, 0) AS n_licences, coalesce(licences, '') AS licences, best_licence, best_dice
    FROM documents d LEFT JOIN named n ON d.doc_id = n.doc_id
    """
