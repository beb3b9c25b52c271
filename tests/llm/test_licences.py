import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from landstrata.llm import licences, queries

FILES = [
    (1, "a/b/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code"), (3, "a/y.py", "x\nLicensed under the Apache License, Version 2.0.\ny"),
    (4, "a/z.py", ""), (5, "q.py", None), (6, None, "Released under the MIT License."), (7, "a/b/c/d.py", "Licensed under CC BY-SA 4.0."),
    (7, "a/b/c/d.py", "Licensed under CC BY-SA 4.0."), (8, "a/b/e/f.py", "the license of this work"), (9, "a/b/n.py", "Licensed under the Apache License, Version 2.0"),
    (None, "a/b/n.py", "Licensed under the Apache License, Version 2.0"), (10, "/r/s/t", "long " * 30_000),
]
SCHEMA = "doc_id long, path string, text string, licence int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def plain(rows, threshold=licences.THRESHOLD):
    """(key, path, licence, origin, directory) by cosines of whole term counts and a walk up the folders."""
    split = lambda t: [x for x in re.split(r"[^\w.]+|\.(?!\w)|(?<!\w)\.", t.lower().replace("_", " ")) if x]
    n = len(rows)
    templates = [(spdx, collections.Counter(split(said)), paragraph, decides) for _, spdx, said, paragraph, decides in licences.ALL]
    vocabulary = set().union(*(counts for _, counts, _, _ in templates))
    df = collections.Counter(t for _, _, text in rows for t in set(split(text or "")) & vocabulary)
    weight = lambda t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1

    def cosine(a, b):
        norm = lambda s: math.sqrt(sum((c * weight(t)) ** 2 for t, c in s.items()))
        return sum(a[t] * b[t] * weight(t) ** 2 for t in a.keys() & b.keys()) / (norm(a) * norm(b))

    own = []
    for _, _, text in rows:
        best = None
        units = [(False, u) for u in re.split(r"[\n\r]+|(?<=[.!?;])[ \t]+", text or "")]
        bare = "\n".join(re.sub(r"^[ \t]*(?:#+|//+|/?\*+/?|--+|;+|%+)?[ \t]*", "", line) for line in (text or "").split("\n"))
        units += [(True, u) for u in re.split(r"\n(?:[ \t\r]*\n)+", bare) if re.search(licences.ANCHOR, u)]
        for kind, unit in units:
            terms = collections.Counter(split(unit))
            if len(terms.keys() & vocabulary) >= max(1, len(terms) * threshold * threshold):
                for spdx, said, paragraph, decides in templates:
                    near = round(cosine(terms, said), 9)
                    if paragraph == kind and near >= threshold and (best is None or (not decides, -near, spdx) < best):
                        best = (not decides, -near, spdx)
        own.append(best and best[2])
    folders = {}
    for (_, path, _), licence in zip(rows, own):
        if path is not None and licence:
            named = bool(re.search(r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$", path))
            folders.setdefault(path.rpartition("/")[0], []).append((named, licence))
    chosen = {}
    for folder, votes in folders.items():
        chosen[folder] = min({v for _, v in votes}, key=lambda v: (-sum(a for a, b in votes if b == v), -sum(b == v for _, b in votes), v))
    out = []
    for (key, path, _), licence in zip(rows, own):
        at = None
        if licence is None and path is not None:
            at = path.rpartition("/")[0]
            while at not in chosen and at:
                at = at.rpartition("/")[0]
            at = at if at in chosen else None
        out.append((key, path, licence or chosen.get(at), "own" if licence else "inherited" if at is not None else None, at))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.path, r.licence, r.origin, r.directory) for r in df.collect()), key=str)


def test_files(spark):
    out = licences.licences(frame(spark, FILES), F.col("path"))
    assert out.columns == ["doc_id", "path", "licence", "score", "origin", "directory"]
    assert got(out) == plain(FILES)
    assert {r[0]: r[2:] for r in got(out)}[2] == ("CC-BY-SA-4.0", "inherited", "a/b/c")
    assert licences.licences(frame(spark, FILES).limit(0), F.col("path")).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    said = [s for _, s in licences.TEMPLATES]
    rows = []
    for k in range(150):
        path = "/".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) + rng.choice(["/LICENSE", "/f.py", "/g"])
        words = rng.choice(said).split() if rng.random() < 0.4 else []
        if words and rng.random() < 0.5:
            words.insert(rng.randrange(len(words)), rng.choice(["really", "the", "license"]))
        rows.append((k, path.lstrip("/"), rng.choice(["", "Some words here. ", "x\n"]) + " ".join(words) + rng.choice([".", " and more of it", "\nend"])))
    assert got(licences.licences(frame(spark, rows), F.col("path"))) == plain(rows)


def test_documents_need_no_python(spark, sf):
    out = queries.op5_license_scan(spark, sf)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    rows = out.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert {r.doc_id for r in rows if r.origin == "own"} == {k for k, t in texts.items() if "icensed under" in t or "Released under" in t}


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Copyright (c) 2019, The Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL = """/*
 * A program.
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
import os
"""


def test_real_texts_and_what_inherits_from_them(spark):
    rows = [
        (1, "m/LICENSE", MIT), (2, "m/src/a.py", "print(1)"), (3, "b3/LICENSE.txt", BSD.format(THIRD)), (4, "b3/x/y.c", ""), (5, "b2/COPYING", BSD.format("")),
        (6, "b2/z.c", None), (7, "i/LICENCE", ISC), (8, "i/q", "x"), (9, "g/main.c", GPL), (10, "a/b.py", APACHE), (11, "c/d.py", "no licence is granted by permission of anyone"),
    ]
    out = got(licences.licences(frame(spark, rows), F.col("path")))
    assert out == plain(rows)
    named = {r[0]: (r[2], r[3]) for r in out}
    assert named == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("BSD-3-Clause", "own"), 4: ("BSD-3-Clause", "inherited"), 5: ("BSD-2-Clause", "own"),
        6: ("BSD-2-Clause", "inherited"), 7: ("ISC", "own"), 8: ("ISC", "inherited"), 9: ("GPL-3.0", "own"), 10: ("Apache-2.0", "own"), 11: (None, None),
    }


def test_terms_that_tell_a_statement():
    rng = random.Random(3)
    split = lambda t: re.findall(r"[\w-]+(?:\.\w+)*", t.lower())
    vectors, idf = {}, {}
    for n, (_, said) in enumerate(licences.TEMPLATES):
        counts = collections.Counter(split(said))
        weights = {t: c * idf.setdefault(t, rng.uniform(1, 9)) for t, c in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        vectors[n] = {t: w / norm for t, w in weights.items()}
    for threshold in (0.0, 0.3, 0.75, 1.0):
        heavy = set(licences.telling(vectors, threshold))
        for units in vectors.values():  # what shares all other terms with a template is not like it
            assert math.sqrt(sum(u * u for t, u in units.items() if t not in heavy)) < max(threshold, 1e-9)
    assert len(licences.telling(vectors, 0.75)) < len(licences.telling(vectors, 0.3)) < len(idf)
    assert licences.telling(vectors, 1.1) == [] and licences.telling({}, 0.75) == []


def test_only_sentences_that_may_be_statements_are_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(licences, "materialise", lambda df, keep=licences.materialise: stored.append(keep(df)) or stored[-1])
    prose = "And of the use. This is by the use of the; to this and to the use by the. Is this in?"
    rows = [(k, f"a/{k}", prose) for k in range(40)] + [(k, f"b/{k}", f"{prose}\nRELEASED under the MIT license! {prose}") for k in range(40, 43)]
    assert got(licences.licences(frame(spark, rows), F.col("path"))) == plain(rows)
    (units,) = [df for df in stored if "sentences" in df.columns]
    assert {(r.doc_id, *r.sentences) for r in units.collect() if r.sentences} == {(k, "RELEASED under the MIT license!") for k in range(40, 43)}
