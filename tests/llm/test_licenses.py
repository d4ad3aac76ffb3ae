"""License scan against brute force, inheritance, edges."""

import math
import re
from collections import Counter

from mentionlake.llm import licenses
from mentionlake.llm.plans import op4_licenses

WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def brute(pages):
    """{key: (license, score)} of the pages' own licenses."""
    lines = {k: [WORD.findall(x.lower()) for x in re.split("[\r\n]+", re.sub("<[^>]*>", "\n", t or ""))] for k, t in pages}
    lines = {k: [x for x in v if x] for k, v in lines.items()}
    vocabulary = {w for n in licenses.TEMPLATES.values() for w in WORD.findall(n.lower())}
    df, n = Counter(), 0
    for v in lines.values():
        for x in v:
            hits = set(x) & vocabulary
            df.update(hits)
            n += max(1, len(hits))
    idf = lambda w: math.log((n + 1) / (df[w] + 1)) + 1
    rare = math.log((n + 1) / 2) + 1
    vectors = {}
    for t, notice in licenses.TEMPLATES.items():
        v = {w: c * idf(w) for w, c in Counter(WORD.findall(notice.lower())).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors[t] = {w: x / norm for w, x in v.items()}
    out = {}
    for k, v in lines.items():
        best = []
        for x in v:
            tf = Counter(w for w in x if w in vocabulary)
            if sum(tf.values()) < 2:
                continue
            norm = math.sqrt(sum((c * idf(w)) ** 2 for w, c in tf.items()) + (len(x) - sum(tf.values())) * rare**2)
            for t, u in vectors.items():
                score = round(sum(c * idf(w) * u.get(w, 0) for w, c in tf.items()) / norm, 9)
                if score >= licenses.THRESHOLD:
                    best.append((-score, t))
        if best:
            out[k] = min(best)[1]
    return out


MIT, GPL = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]


def test_inheritance_and_edges(frame):
    rows = [
        (1, "https://a.org/lib/LICENSE.txt", MIT), (2, "https://a.org/lib/x/y/page", "text"), (3, "http://a.org/lib/x/?q=1#t", f"<p>{GPL}</p>"),
        (4, "https://a.org/lib/x/z/q.html", "words"), (5, "https://a.org/other/q", "words"), (6, "https://a.org/library/q", "x"),
        (7, "https://b.org/lib/q", "x"), (8, None, GPL), (9, "", None), (10, "no-path", MIT.upper()), (None, "https://a.org/lib/n", ""),
        (2, "https://a.org/lib/x/y/page", "text"), (11, "https://a.org/lib/w/page.html", "released under the sea by mit students of the license office"),
        (12, "https://a.org/lib/big", "word " * 50_000 + "\n" + GPL),
    ]
    df = frame([(*r, "own", 1) for r in rows], "page_id long, url string, html string, origin string, score int")
    out = [(r["page_id"], r["license"], r["origin"]) for r in licenses.scan(df).collect()]
    assert len(out) == len(rows)
    assert set(out) == {
        (1, "MIT", "own"), (2, "GPL-3.0", "inherited"), (3, "GPL-3.0", "own"), (4, "GPL-3.0", "inherited"), (5, None, None), (6, None, None),
        (7, None, None), (8, "GPL-3.0", "own"), (9, None, None), (10, "MIT", "own"), (None, "MIT", "inherited"), (11, "MIT", "inherited"),
        (12, "GPL-3.0", "own"),
    }
    assert licenses.scan(df.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    want = brute([(r["page_id"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()])
    out = op4_licenses(spark, folder).collect()
    assert want and {r["page_id"]: r["license"] for r in out if r["origin"] == "own"} == want


def test_untelling_words_cannot_reach_the_threshold(spark):
    """What is left of a template without its telling words is shorter than the threshold."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    lines = [set(WORD.findall(x.lower())) for r in pages for x in re.split("[\r\n]+", re.sub("<[^>]*>", "\n", r["html"] or ""))]
    df = Counter(w for x in lines for w in x)
    idf = lambda w: math.log((len(lines) + 1) / (df[w] + 1)) + 1
    for notice in licenses.TEMPLATES.values():
        weight = {w: c * idf(w) for w, c in Counter(WORD.findall(notice.lower())).items()}
        left = {w: x for w, x in weight.items() if not re.search(licenses.TELLING, w)}
        assert sum(x * x for x in left.values()) < licenses.THRESHOLD**2 * sum(x * x for x in weight.values())


def test_whole_texts_headers_and_short_forms(frame):
    from pathlib import Path

    text = lambda name: (Path(licenses.__file__).parent / "license_texts" / f"{name}.txt").read_text()
    wrapped = """# This program is free software: you can redistribute it and/or modify
        # it under the terms of the GNU General Public License as published by
        # the Free Software Foundation, either version 3 of the License, or
        # (at your option) any later version."""
    gpl = text("GPL-3.0").split("END OF TERMS AND CONDITIONS")[0]  # without the header at its end
    filler = "\n".join(f"line {i} of words about nothing in particular" for i in range(60))
    rows = [
        (1, "https://a.org/mit/LICENSE", "Copyright (c) 2020 Some One\n\n" + text("MIT")), (2, "https://a.org/mit/x/page", "words"),
        (3, "https://a.org/gpl/COPYING", gpl), (4, "https://a.org/gpl/page", "words"), (5, "https://a.org/f/a.py", wrapped + "\nimport os"),
        (6, "https://a.org/f/b.py", "// SPDX-License-Identifier: Apache-2.0\n" + filler), (7, "https://a.org/f/c", "Licensed under CC BY 4.0."),
        (8, "https://a.org/bsd/LICENSE.txt", text("BSD-3-Clause").replace("REGENTS", "COPYRIGHT HOLDERS")), (9, "https://a.org/f/d", "MIT License"),
        (10, "https://a.org/apache/license", text("Apache-2.0")), (11, "https://a.org/f/e", filler), (12, "https://a.org/f/g", gpl[:3000]),
        (13, "https://a.org/f/h", "/* Licensed under the Apache License,\n * Version 2.0 (see LICENSE for details) */"),
        (14, "https://a.org/lgpl/COPYING.LESSER", text("LGPL-3.0")), (15, "https://a.org/f/i", "SPDX-License-Identifier: GPL-2.0-or-later"),
        (1, "https://a.org/mit/LICENSE", "Copyright (c) 2020 Some One\n\n" + text("MIT")),
    ]
    out = {(r["page_id"], r["license"], r["origin"]) for r in licenses.scan(frame(rows, "page_id long, url string, html string")).collect()}
    assert out == {
        (1, "MIT", "own"), (2, "MIT", "inherited"), (3, "GPL-3.0", "own"), (4, "GPL-3.0", "inherited"), (5, "GPL-3.0", "own"),
        (6, "Apache-2.0", "own"), (7, "CC-BY-4.0", "own"), (8, "BSD-3-Clause", "own"), (9, "MIT", "own"), (10, "Apache-2.0", "own"),
        (11, None, None), (12, "GPL-3.0", "own"), (13, "Apache-2.0", "own"), (14, "LGPL-3.0", "own"), (15, "GPL-2.0", "own"),
    }


def test_scores_do_not_change_with_the_size_of_the_table(frame):
    lines = ["This project is released under the MIT License", "Released under the MIT License (see LICENSE for details)",
             "this is a text of the public", "under the terms of it", *["words of a line about something"] * 6]
    schema = "page_id long, url string, html string"
    got = []
    for copies in (1, 10, 300):
        rows = [(i * copies + j, f"https://a.org/{i}", x) for i, x in enumerate(lines) for j in range(copies)]
        out = {(r["url"], r["license"], r["score"]) for r in licenses.scan(frame(rows, schema)).collect()}
        assert len(out) == len(lines)
        got.append(out)
    assert got[0] == got[1] == got[2]
    assert {(p, x) for p, x, _ in got[0] if x} == {("https://a.org/0", "MIT"), ("https://a.org/1", "MIT")}


def test_notices_are_found_whatever_the_weights():
    """Without its telling words no template reaches the threshold, at any counts of words."""
    import random

    for lines in (1, 1000, 10**9):
        pick = random.Random(lines)
        counts = {w: pick.randint(0, lines) for _, text, _, _ in licenses.templates() for w in text}
        for vector in licenses.shares(licenses.weights(counts, lines)[0]):
            left = set(vector) - set(licenses.telling(vector, counts))
            assert sum(vector[w] ** 2 for w in left) < licenses.THRESHOLD**2
