"""License scans: sparse TF-IDF cosine of statements to templates, then the nearest directory above, in SQL only.

A text's units are compared with the templates: its sentences with wordings that name a licence, and its
paragraphs, joined over line breaks and without comment marks, with the standard headers and the
paragraphs of licence files. A term weighs by how often the unit has it and by its inverse document
frequency over all rows; terms outside the templates weigh as terms of no document, so a unit that says
much else is unlike every template. Units without any of the templates' heaviest terms are left out
early, as no cosine of theirs is large enough (prefix filtering). A file without a statement of its own
takes the licence of the nearest directory above it that has one, found by joining its directories' paths.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.session import materialise, small_side

THRESHOLD = 0.75

# Wordings that name a licence, with its SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This software is licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause License"),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Released under the CC0 1.0 Public Domain Dedication"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
# Paragraphs of licence texts and standard headers. A paragraph that only one of several like
# licences has decides between them.
PARAGRAPHS = (
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
)
DECIDING = (
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
)
# (number, licence, text, whether a paragraph, whether it decides)
ALL = tuple(
    (n, licence, said, paragraph, decides)
    for n, (licence, said, paragraph, decides) in enumerate(
        [(*t, False, False) for t in TEMPLATES] + [(*t, True, False) for t in PARAGRAPHS] + [(*t, True, True) for t in DECIDING]
    )
)
# Words of which a paragraph must have one to be looked at.
ANCHOR = r"(?i)licen[cs]e|redistribut|permission|unencumbered|copyright holder"
_SENTENCE = r"[\n\r]+|(?<=[.!?;])[ \t]+"
_APART = r"[^\p{L}\p{N}.]+|\.(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])\."


_MARK = r"(?m)^[ \t]*(?:#+|//+|/?\*+/?|--+|;+|%+)?[ \t]*"
_BLANK = r"\n(?:[ \t\r]*\n)+"


def terms(text: Column) -> Column:
    """The terms of a text, in lower case; a dot within a number or name belongs to it."""
    return F.filter(F.split(F.lower(text), _APART), lambda t: t != "")


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text that may state a licence, without comment marks; null and empty texts have none."""
    some = F.filter(F.split(F.regexp_replace(text, _MARK, ""), _BLANK), lambda p: p.rlike(ANCHOR))
    return F.when(text.rlike(ANCHOR), some).otherwise(F.array().cast("array<string>"))


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def telling(templates: dict[int, dict[str, float]], threshold: float) -> list[str]:
    """Terms of which a unit has one if its cosine with any of the templates is `threshold` or more.

    `templates` gives each one's terms with their weights in a vector of length 1. A unit's cosine with a
    template is at most the length of the part that both share. So the heaviest terms are taken until what
    is left is shorter than `threshold` (less 1e-6, as scores are rounded): first those already taken for
    other templates, last those of one or two characters, as they are part of many words.
    """
    least = max(threshold - 1e-6, 0.0) ** 2
    taken: set[str] = set()
    for _, units in sorted(templates.items()):
        left = sorted(units, key=lambda t: (t not in taken, len(t) < 3, -units[t], t))
        while left and math.fsum(units[t] ** 2 for t in left) >= least:
            taken.add(left.pop(0))
    return sorted(taken)


def _units(rows: DataFrame, vocabulary: list[str], of_sentences: list[str], of_paragraphs: list[str], threshold: float) -> DataFrame:
    """(doc_id, path, sentences, paragraphs): the units of every row that are looked at and have a telling term."""
    among = lambda t, some: F.size(F.filter(t, lambda term: term.isin(some)))

    def likely(unit: Column, heavy: list[str]) -> Column:
        share = lambda t: F.greatest(F.lit(1.0), F.size(t) * threshold * threshold)
        return _let(F.array_distinct(terms(unit)), lambda t: (among(t, heavy) > 0) & (among(t, vocabulary) >= share(t)))

    def worth_cutting(unit: Column) -> Column:  # a term is part of the text it is cut from
        return _let(F.lower(unit), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in of_sentences], F.lit(False)))

    text = F.coalesce("text", F.lit(""))
    sentences = F.filter(F.split(text, _SENTENCE), lambda s: worth_cutting(s) & likely(s, of_sentences))
    return rows.select("doc_id", "path", sentences.alias("sentences"), F.filter(paragraphs(text), lambda p: likely(p, of_paragraphs)).alias("paragraphs"))


def licences(files: DataFrame, path: Column, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, path, licence, score, origin, directory): the licence of every file.

    `path` gives a file's path with "/" between its parts. `own`: a sentence of the file is like a
    template's wording, or a paragraph like one of a licence or header, with a cosine of `threshold` or
    more; of these a deciding paragraph counts first, then the likest one, ties by identifier. A unit is
    looked at if its distinct terms are known to the templates to a share of `threshold` squared. A
    directory has the licence that most of its own files named LICENSE, LICENCE, COPYING or NOTICE
    state, or of all its own files if none of those does; ties by identifier. `inherited`: the file has
    none, and the nearest directory above has it. Otherwise licence, score, origin and directory are null.

    Null and empty texts state nothing; texts may be of any length. A null path lies in no directory. All
    rows are returned, repeated ones and null keys too; an empty table gives an empty result. Other
    columns are not looked at.
    """
    rows = files.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), path.alias("path"))
    spark = files.sparkSession
    wording = spark.createDataFrame(list(ALL), "template int, licence string, said string, paragraph boolean, decides boolean")
    wording = wording.withColumn("term", F.explode(terms(F.col("said")))).groupBy("template", "licence", "paragraph", "decides", "term")
    wording = wording.agg(F.count(F.lit(1)).alias("tf"))
    vocabulary = sorted(r.term for r in wording.select("term").distinct().collect())  # the fixed templates' terms
    known = F.array(*map(F.lit, vocabulary))

    # How many rows hold each of the templates' terms: a number for each term and one for all rows.
    held = rows.select(F.explode(F.concat(F.array_intersect(terms(F.coalesce("text", F.lit(""))), known), F.array(F.lit("")))).alias("term"))
    seen = {r.term: r.n for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = F.lit(float(seen.get("", 0)))
    idf = lambda n: F.log((total + 1) / (n + 1)) + 1
    weights = F.broadcast(spark.createDataFrame([(t, seen.get(t, 0)) for t in vocabulary], "term string, n long").select("term", idf(F.col("n")).alias("w")))
    most = idf(F.lit(0.0))
    wording = wording.join(weights, "term").withColumn("w", F.col("tf") * F.col("w"))
    norms = wording.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    wording = wording.join(norms, "template").select("template", "licence", "paragraph", "decides", "term", (F.col("w") / F.col("norm")).alias("unit"))
    wording = F.broadcast(materialise(wording))
    weighed: dict[bool, dict[int, dict[str, float]]] = {False: {}, True: {}}
    for r in wording.collect():  # the fixed templates' terms
        weighed[r.paragraph].setdefault(r.template, {})[r.term] = r.unit

    some = _units(rows, vocabulary, telling(weighed[False], threshold), telling(weighed[True], threshold), threshold)
    some = materialise(some.withColumn("row", F.monotonically_increasing_id()))
    units = [some.select("row", F.lit(kind == "paragraphs").alias("paragraph"), F.explode(F.array_distinct(kind)).alias("said")) for kind in ("sentences", "paragraphs")]
    at = ["row", "paragraph", "said"]
    counted = units[0].unionByName(units[1]).select(*at, F.explode(terms(F.col("said"))).alias("term")).groupBy(*at, "term").agg(F.count(F.lit(1)).alias("tf"))
    counted = counted.join(weights, "term", "left").withColumn("w", F.col("tf") * F.coalesce("w", most))
    norms = counted.groupBy(*at).agg(F.sum(F.col("w") * F.col("w")).alias("norm2"))
    dots = counted.join(wording, ["term", "paragraph"]).groupBy(*at, "template", "licence", "decides").agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    near = dots.join(norms, at).select("row", "licence", "decides", F.round(F.col("dot") / F.sqrt("norm2"), 9).alias("score")).where(F.col("score") >= threshold)
    own = near.groupBy("row").agg(F.min(F.struct((~F.col("decides")).alias("d"), (-F.col("score")).alias("s"), "licence")).alias("best"))
    own = some.select("row", "doc_id", "path").join(own, "row", "left")
    own = own.select("doc_id", "path", F.col("best.licence").alias("own"), (-F.col("best.s")).alias("score"), _directory("path").alias("at"))
    return _inherited(materialise(own), key)


def _directory(path: str) -> Column:
    """The directory of a path, without a slash at its end; the top is the empty path."""
    return F.regexp_replace(F.regexp_replace(path, r"[^/]*$", ""), r"/+$", "")


def _above(directory: Column) -> Column:
    """A directory and all above it, down to the top."""
    parts = F.split(directory, "/")
    return F.array_distinct(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))


def _inherited(own: DataFrame, key: str) -> DataFrame:
    """Joins directories, which are fewer than files, with the licensed ones above them."""
    named = F.col("path").rlike(r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$").cast("int")
    votes = own.where("own is not null and at is not null").groupBy("at", "own").agg(F.sum(named).alias("named"), F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("named")).alias("a"), (-F.col("n")).alias("b"), F.col("own").alias("licence")))
    licensed = votes.groupBy("at").agg(best.alias("best")).select(F.col("at").alias("directory"), F.col("best.licence").alias("licence"))

    folders = own.where("at is not null").select("at").distinct()
    up = folders.select("at", F.explode(_above(F.col("at"))).alias("directory")).join(licensed, "directory")
    nearest = up.groupBy("at").agg(F.max(F.struct(F.length("directory").alias("l"), "directory", "licence")).alias("top"))
    nearest, _ = small_side(nearest.select("at", "top.directory", "top.licence"))
    out = own.join(nearest, "at", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("licence").isNotNull(), "inherited")
    return out.select(
        F.col("doc_id").alias(key), "path", F.coalesce("own", "licence").alias("licence"), "score", origin.alias("origin"),
        F.when(F.col("own").isNull(), F.col("directory")).alias("directory"),
    )
