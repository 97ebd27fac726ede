import math
import re
from collections import Counter

from odd import FOLDER, docs, no_docs, odd_docs
from pyspark.sql import functions as F

from massloom.llm.license_scan import LEAST, LICENSE_FILE, TEMPLATES, leading_terms, license_scan, template_vectors

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
words = lambda t: [w for w in re.split("[^a-z0-9]+", t.translate(LOWER)) if w]


def brute(rows, opening_counts, least=LEAST):
    """rows of (doc_id, path, text)"""
    df = Counter(w for *_, t in rows for w in set(words(t or "")))
    idf = lambda w: math.log((len(rows) + 1) / (df[w] + 1)) + 1

    def vector(text):
        x = {w: n * idf(w) for w, n in Counter(words(text)).items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        return {w: v / size for w, v in x.items()} if size else {}

    templates = [(name, vector(t)) for name, ts in TEMPLATES.items() for t in ts]
    own = []
    for _, path, text in rows:
        named = path is not None and re.search(LICENSE_FILE, path.rsplit("/", 1)[-1]) is not None
        parts = [(k == 0, s) for k, s in enumerate(s for s in re.split(r"\n+|(?<=[.!?])\s+", text or "") if s.strip(" "))]
        parts += [(k == 0, s) for k, s in enumerate(re.split(r"\n(?:[^A-Za-z0-9\n]*\n)+", text or ""))] + ([(False, text or "")] if named else [])
        hits = []
        for k, part in parts:
            v = vector(part)
            hits += [(-s, name, k) for name, t in templates if (s := round(sum(v.get(w, 0) * x for w, x in t.items()), 9)) >= least]
        own.append((named, min(h[:2] for h in hits) if hits else None, any(h[2] for h in hits)))
    grants = {}
    for (_, path, _), (named, hit, opening) in zip(rows, own, strict=True):
        if hit and path is not None and (named or opening_counts and opening):
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            grants[d] = min(grants.get(d, hit), hit)
    out = []
    for (i, path, _), (_, hit, _) in zip(rows, own, strict=True):
        at = None
        if not hit and path is not None:
            steps = path.split("/")[:-1]
            at = next((d for k in range(len(steps), -1, -1) if (d := "/".join(steps[:k])) in grants), None)
        got = hit or (grants[at] if at is not None else None)
        out.append((i, path, got and got[1], "notice" if hit else "none" if at is None else "inherited", got and round(-got[0], 6), at))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.path, r.license, r.basis, None if r.score is None else round(r.score, 6), r.from_dir) for r in df.collect()), key=repr)


def files(spark, rows):
    return docs(spark, [(i, t, p) for i, p, t in rows])


TREE = [
    (1, "repo/LICENSE", "Licensed under the Apache License, Version 2.0.\nmore text"), (2, "repo/src/a.py", "code"), (3, "repo/src/deep/b.py", "code"),
    (4, "repo/src/deep/COPYING.txt", "Released under the MIT License."), (5, "repo/src/deep/er/c.py", None), (6, "repo/src/d.py", "x. All rights reserved."),
    (7, "top.py", ""), (8, None, "All rights reserved."), (9, None, "nothing"), (10, "other/x.py", "the license of all"), (11, "other/license.py", "no notice"),
    (12, "repo/src/deepx/e.py", "e"), (13, "repo/src/deep/er/c.py", None), (14, "repo/license-mit", "MIT"), (15, "z/y/w.py", "LICENSED UNDER CC BY-NC 4.0! Or else"),
]


def test_nearest_ancestor(spark):
    got = found(license_scan(files(spark, TREE), F.col("source")))
    assert got == brute(TREE, False)
    by_id = {r[0]: r for r in got}
    assert by_id[2][2:4] == ("Apache-2.0", "inherited") and by_id[3][2] == "MIT" and by_id[5][5] == "repo/src/deep"
    assert by_id[6][3] == "notice" and by_id[12][5] == "repo" and by_id[7][3] == "none" and by_id[15][2] == "CC-BY-NC-4.0"


def test_root_grants_to_all(spark):
    rows = [*TREE, (20, "LICENSE", "All rights reserved.")]
    assert found(license_scan(files(spark, rows), F.col("source"))) == brute(rows, False)


def test_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    rows = [tuple(r) for r in table.select("doc_id", path, "text").collect()]
    assert found(license_scan(table, path, opening_counts=True)) == brute(rows, True)


def test_leading_terms_lose_nothing():
    names = {w for ts in TEMPLATES.values() for t in ts for w in words(t)}
    idf = {w: 1.0 + len(w) / 3 for w in names}
    vectors = template_vectors(TEMPLATES, idf)
    leads = set(leading_terms(vectors, LEAST))
    for k in {v[1] for v in vectors}:
        rest = [x for _, n, w, x in vectors if n == k and w not in leads]
        assert sum(x * x for x in rest) < LEAST**2


def test_odd_rows(spark):
    given = odd_docs(spark)
    got = found(license_scan(given, F.col("source")))
    assert len(got) == 13 and all(r[3] == "none" for r in got)
    assert license_scan(no_docs(spark), F.col("source")).count() == 0


def test_a_directory_with_a_third_of_all_files(spark):
    rows = [(i, f"hot/{i}" if i % 3 else f"d{i}/x", "text") for i in range(200)] + [(500, "hot/LICENSE", "Released under the MIT License.")]
    assert found(license_scan(files(spark, rows), F.col("source"))) == brute(rows, False)


MIT_FILE = """MIT License

Copyright (c) 2019 Someone Else

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL_HEADER = """/*
 * widget.c - a widget
 * Copyright (C) 2020  A. Author
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 */
int main() {{}}
"""
APACHE_HEADER = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
import os
"""
BSD_FILE = """Copyright 2011 Somebody. All rights kept by them.

""" + next(t for t in TEMPLATES["BSD-2-Clause"]).replace(". THIS", ".\n\nTHIS")


def test_headers_and_files_as_they_are_published(spark):
    third = "\n\nNeither the name of Somebody nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    rows = [
        (1, "a/LICENSE", MIT_FILE), (2, "a/x.c", "int x;"), (3, "b/w.c", GPL_HEADER.format(3)), (4, "b/v.c", GPL_HEADER.format(2).replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")),
        (5, "c/m.py", APACHE_HEADER), (6, "d/COPYING", BSD_FILE), (7, "e/COPYING", BSD_FILE + third), (8, "f/y.py", "# a comment on free software and the terms of use\nprint(1)"),
        (9, "g/LICENSE.txt", MIT_FILE.replace("\n", "\r\n")), (10, "h/isc.h", "// Permission to use, copy, modify, and/or distribute this software for any\n// purpose with or without fee is hereby granted, provided that the above\n// copyright notice and this permission notice appear in all copies.\n"),
    ] + [(100 + i, f"z/{i}", "plain words of a file about nothing in particular") for i in range(60)]
    got = found(license_scan(files(spark, rows), F.col("source")))
    assert got == brute(rows, False)
    by_id = {r[0]: r[2:4] for r in got}
    assert by_id[1] == ("MIT", "notice") and by_id[2] == ("MIT", "inherited") and by_id[9] == ("MIT", "notice")
    assert by_id[3] == ("GPL-3.0", "notice") and by_id[4] == ("GPL-2.0", "notice") and by_id[5] == ("Apache-2.0", "notice")
    assert by_id[6] == ("BSD-2-Clause", "notice") and by_id[7] == ("BSD-3-Clause", "notice") and by_id[10] == ("ISC", "notice")
    assert by_id[8][1] == by_id[100][1] == "none"
