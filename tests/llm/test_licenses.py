from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from dailymart.llm import licenses

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
PROSE = "thner ofor the and inea\nwhst thorea of it"

FILES = [
    (1, "a/LICENSE", "notes\n" + GPL + "\n" + PROSE),
    (2, "a/x.py", PROSE),
    (3, "a/b/y.py", f"{MIT}\n{PROSE}"),
    (4, "a/b/c/z.py", PROSE),
    (5, "a/b/c/d/own.py", f"{PROSE}\n# {MIT.upper()}"),
    (6, "a/bb/z.py", PROSE),
    (7, "q/r.txt", "A licence is mentioned in passing, among many other things that have no bearing on it"),
    (8, "q/COPYING", MIT),
    (9, "q/s/t.txt", None),
    (10, "q/s/u.txt", ""),
    (11, None, PROSE),
    (12, "top.txt", PROSE),
    (13, "w/v.txt", "The licence of MIT was released under pressure\nPublic domain\n" + MIT.replace("License", "Licence")),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("x"))


def words(text):
    return re.findall("[a-z0-9]+", text.lower())


def brute_own(files):
    """Best licence of each text: every unit with every template."""
    df = Counter(w for _, _, t in files for w in set(words(t or "")))
    vocabulary = {w for _, s in licenses.TEMPLATES for w in words(s)}
    idf = lambda w: math.log((1 + len(files)) / (1 + (df[w] if w in vocabulary else 0))) + 1

    def vector(text):
        return {w: n * idf(w) for w, n in Counter(words(text)).items()}

    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for i, _, text in files:
        units = [(-1, text)] + list(enumerate((text or "").split("\n")))
        found = []
        for line, unit in units:
            if unit and re.search(licenses.CUES, unit, re.I):
                v = vector(unit)
                for name, statement in licenses.TEMPLATES:
                    t = vector(statement)
                    cosine = round(sum(v[w] * t[w] for w in v.keys() & t.keys()) / (norm(v) * norm(t)), 6)
                    if cosine >= licenses.THRESHOLD:
                        found.append((-cosine, line, name))
        if found:
            least, line, name = min(found)
            out[i] = (name, -least, line)
    return out


def test_own_licenses_equal_brute_force(spark):
    found = licenses.own_licenses(frame(spark, FILES).select(F.col("doc_id").alias("row"), "text"))
    assert {r.row: (r.license, r.similarity, r.line) for r in found.collect()} == brute_own(FILES)


def test_nearest_directory_above_passes_its_licence_on(spark):
    got = {r.doc_id: (r.license, r.origin, r.from_path) for r in licenses.scan(frame(spark, FILES).repartition(3)).collect()}
    assert got == {
        1: ("GPL-3.0", "header", "a/LICENSE"),
        2: ("GPL-3.0", "inherited", "a/LICENSE"),
        3: ("MIT", "header", "a/b/y.py"),
        4: ("MIT", "inherited", "a/b/y.py"),
        5: ("MIT", "header", "a/b/c/d/own.py"),
        6: ("GPL-3.0", "inherited", "a/LICENSE"),
        7: ("MIT", "inherited", "q/COPYING"),
        8: ("MIT", "file", "q/COPYING"),
        9: ("MIT", "inherited", "q/COPYING"),
        10: ("MIT", "inherited", "q/COPYING"),
        11: (None, "none", None),
        12: (None, "none", None),
        13: ("MIT", "header", "w/v.txt") if 13 in brute_own(FILES) else (None, "none", None),
    }


BSD = """Copyright (c) 2009, Some One and Others
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

* Redistributions of source code must retain the above copyright notice, this list of conditions and the following
  disclaimer.
* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
  disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """* Neither the name of Some One nor the names of its contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.
"""
ISC = """Copyright 2010-2021 Some One

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.
"""
LONG = """We went to the old house by the river, and the keeper of the house gave us permission to stay for the night. It was
one of the houses that you see in the north of the country, and there was not much to be said for it, or for the work that
had been done on the roof of it. In the morning we left with all that we had, and walked along the water to the next town.
"""


def test_common_licence_files_are_known_by_their_full_text(spark):
    texts = {n: t for n, t in licenses.TEMPLATES if len(t) > 5000}
    rows = [(1, "a/LICENSE", BSD.format("")), (2, "b/LICENSE", BSD.format(THIRD)), (3, "c/LICENSE", ISC), (4, "d/LICENSE", LONG), (5, "e/x", LONG * 9)]
    rows += [(10 + k, f"f{k}/COPYING", texts[n]) for k, n in enumerate(sorted(texts))]
    rows += [(100 + k, f"p/{k}", PROSE) for k in range(40)]
    own = {r.doc_id: (r.license, r.origin) for r in licenses.scan(frame(spark, rows)).collect() if r.doc_id < 100}
    want = {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "ISC"} | {10 + k: n for k, n in enumerate(sorted(texts))}
    assert sorted(texts) == ["Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0"]
    assert own == {i: (n, "file") for i, n in want.items()} | {4: (None, "none"), 5: (None, "none")}


def test_repeated_rows_root_licence_and_empty_table(spark):
    rows = [(1, "LICENSE", MIT), (1, "LICENSE", MIT), (2, "/x//y.txt", PROSE), (2, "/x//y.txt", PROSE), (None, "z", "w " * 100_000)]
    got = sorted(((r.doc_id or 0, r.origin, r.from_path) for r in licenses.scan(frame(spark, rows)).collect()))
    assert got == [(0, "inherited", "LICENSE"), (1, "file", "LICENSE"), (1, "file", "LICENSE"), (2, "inherited", "LICENSE"), (2, "inherited", "LICENSE")]
    assert licenses.scan(frame(spark, rows).limit(0)).collect() == []
