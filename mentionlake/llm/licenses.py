"""License scan: TF-IDF cosine of lines, headers and whole files to templates, and inheritance along directories.

Templates are one-sentence notices, short names, standard headers, SPDX lines and whole license texts. Texts
are cut into words (tags count as line ends); texts and templates are sparse vectors of words weighted by
the share of all lines of the corpus that hold them (1 - ln of it, shares below ``RARE`` count as ``RARE``, so
weights do not grow with the table) and by 1 + ln of their count. Three kinds of vectors
are made: one of each line, one of each place where a notice, header or text of up to ``HEADER`` words may lie
(as many words as the template has, across line ends, so wrapped headers and notices inside long lines are
found), and one of each whole license file. A page carries the license of the vector most like a template,
from ``THRESHOLD`` on. A license file (a directory's index or a file called license, licence, copying or
notice) that carries one grants it to its directory and everything below; a page without its own inherits
from the nearest directory above it that has a grant.

A template's telling words are those of it on fewest lines, as many as it takes for nothing to reach the
threshold without them by the weights of the run; lines and places without one are not compared. A template of a place is laid so that one of
its telling words falls on the same word of the page. Lines longer than ``LINE`` words are compared by places
only. Only words of templates are counted; the weight of every other word is that of the rarest.
Paths are joined by equality of directory prefixes, of which a page has as many as its
path has parts. Null texts are empty; null or empty paths have no directory and inherit nothing; of equal
scores the template first by name wins, and so it does for several grants of one directory; repeated rows
stay repeated; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake.llm.common import ready
from mentionlake.session import materialize

# Standard notices of common licenses.
TEMPLATES = {
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Standard headers, titles and metadata lines besides the notices above.
HEADERS = {
    "AGPL-3.0": ["""This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version.""", "GNU Affero General Public License Version 3"],
    "Apache-2.0": ["""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
        "Released under the Apache License 2.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International Public License",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": [f"""This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; {version} of the License{later}."""
        for version, later in (("either version 2", ", or (at your option) any later version"), ("version 2", ""))]
        + ["GNU General Public License Version 2", "Licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["""This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version.""", "GNU General Public License Version 3", "Licensed under the GNU General Public License, version 3."],
    "LGPL-2.1": ["""This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version.""", "GNU Lesser General Public License Version 2.1"],
    "LGPL-3.0": ["""This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version.""", "GNU Lesser General Public License Version 3"],
    "MIT": ["Licensed under the MIT License."],
    "MPL-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "Mozilla Public License Version 2.0"],
}
# Names that tell a license only where they are a line of their own.
NAMES = {
    "Apache-2.0": ["Apache License 2.0", "License: Apache-2.0"], "BSD-3-Clause": ["BSD 3-Clause License", "License: BSD-3-Clause"],
    "CC-BY-4.0": ["CC BY 4.0", "Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Attribution-NonCommercial 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Attribution-ShareAlike 4.0 International"],
    "MIT": ["MIT License", "The MIT License (MIT)", "License: MIT"], "Unlicense": ["The Unlicense"],
}
GNU = ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")  # with -only and -or-later in SPDX lines
THRESHOLD = 0.8
HEADER = 300  # most words of a template that is looked for inside a page; a longer one is compared with whole files
LINE = 1000
RARE = 1e-3  # share of lines from which on down a word is as heavy as can be
# Stems of telling words of the one-sentence notices; the scan itself derives telling words from the weights of the run.
TELLING = "|".join([
    "licen", "unencumbered", "domain", "gnu", "apache", "bsd", "mozilla", "creative", "by-nc", "by-sa", "released",
    "subject", "terms", "source", "governed", "affero", "lesser", "attribution", "commons", "public", "software",
])
FILES = r"(?i)^(?:(?:licen[cs]e|copying|notice|index)(?:[.-].*)?)?$"


def words(line: Column) -> Column:
    """Lower-case words of a line; dots and dashes inside a word belong to it."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def directory(path: Column) -> Column:
    """Path without scheme, query, fragment and last part; null where there is none."""
    plain = F.regexp_replace(F.regexp_replace(path, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    return F.when(plain.contains("/"), F.regexp_extract(plain, r"^(.*)/[^/]*$", 1))


def file_name(path: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(path, r"[?#].*$", ""), r"([^/]*)$", 1)


def _plain_words(notice: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", notice.lower())


@cache
def templates() -> list[tuple[str, tuple[str, ...], bool, bool]]:
    """(license, words, whether it is compared with lines, whether with places); others are compared with whole files."""
    out = [(t, n, True, True) for t, n in TEMPLATES.items()]
    out += [(t, n, True, True) for t, notices in HEADERS.items() for n in notices]
    out += [(t, n, True, False) for t, names in NAMES.items() for n in names]
    out += [(t, f"SPDX-License-Identifier: {t}{end}", True, True)
            for t in sorted({*TEMPLATES, *HEADERS}) for end in ("", *(("-only", "-or-later") if t in GNU else ()))]
    out = [(t, tuple(_plain_words(n)), line, place) for t, n, line, place in out]
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = tuple(_plain_words(file.read_text()))
        out.append((file.stem, text, False, len(text) <= HEADER))
    return out


def weights(counts: dict[str, int], lines: int) -> tuple[dict[str, float], float]:
    """(weight of each word of the templates, weight of any other word)."""
    idf = lambda n: 1 - math.log(max(RARE, n / max(1, lines)))
    return {w: idf(counts.get(w, 0)) for _, text, _, _ in templates() for w in text}, idf(0)


def shares(idf: dict[str, float]) -> list[dict[str, float]]:
    """Each template as a vector of length one."""
    out = []
    for _, text, _, _ in templates():
        v = {w: (1 + math.log(n)) * idf[w] for w, n in Counter(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: x / norm for w, x in v.items()})
    return out


def telling(vector: dict[str, float], counts: dict[str, int]) -> list[str]:
    """The words on fewest lines, without which what is left is too short for the threshold."""
    out, left = [], 1.0
    for w, x in sorted(vector.items(), key=lambda e: (counts.get(e[0], 0), -e[1], e[0])):
        if left < THRESHOLD**2 - 1e-9:
            break
        out.append(w)
        left -= x * x
    return out


def _literal(places: dict[str, list[tuple[int, ...]]], names: tuple[str, ...]) -> Column:
    """Map of each word to structs."""
    struct = lambda v: f"named_struct({', '.join(f"'{n}', {x}" for n, x in zip(names, v))})"
    return F.expr(f"map({', '.join(f"'{w}', array({', '.join(map(struct, v))})" for w, v in sorted(places.items()))})")


def candidates(pages: DataFrame, vectors: list[dict[str, float]], counts: dict[str, int]) -> DataFrame:
    """(row, kind, place, size, numbers, words): what is compared with which templates."""
    on_line: dict[str, list[tuple[int, ...]]] = {}
    at_place: dict[str, list[tuple[int, ...]]] = {}
    whole = []
    for number, ((_, text, line, place), vector) in enumerate(zip(templates(), vectors)):
        for w in telling(vector, counts):
            if line:
                on_line.setdefault(w, []).append((number,))
            if place:
                at_place.setdefault(w, []).extend((number, i, len(text)) for i, x in enumerate(text) if x == w)
        if not line and not place:
            whole.append(number)
    lines_of, places_of = _literal(on_line, ("number",)), _literal(at_place, ("number", "back", "size"))
    told = lambda array, known: F.filter(array, lambda w: w.isin(*sorted(known)))
    cut = pages.select("row", "file", F.transform(F.split("bare", "[\r\n]+"), words).alias("lines"))
    # lines: one vector for all templates that share a telling word with it
    lines = (
        cut.select("row", F.posexplode("lines").alias("place", "words")).where(F.size("words").between(1, LINE))
        .withColumn("told", F.array_distinct(told(F.col("words"), on_line))).where(F.size("told") > 0)
        .select("row", F.lit(0).alias("kind"), "place", F.size("words").alias("size"),
                F.array_sort(F.array_distinct(F.flatten(F.transform("told", lambda w: lines_of[w])))["number"]).alias("numbers"), "words")
    )
    # places: as many words as the template has, with a telling word where the template has it
    flat = cut.select("row", "file", F.flatten("lines").alias("words"))
    spots = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda s: s["word"].isin(*sorted(at_place)))
    laid = F.flatten(F.transform("spots", lambda s: F.transform(places_of[s["word"]], lambda p: F.struct(
        (s["at"] - p["back"]).alias("place"), p["size"].alias("size"), p["number"].alias("number")))))
    sliced = F.transform(F.array_distinct(laid), lambda p: F.struct(
        p["place"].alias("place"), p["size"].alias("size"), F.array(p["number"]).alias("numbers"),
        F.slice("words", F.greatest(p["place"], F.lit(0)) + 1, p["size"] + F.least(p["place"], F.lit(0))).alias("words")))
    places = (
        flat.select("row", "words", spots.alias("spots")).where(F.size("spots") > 0)
        .select("row", F.explode(sliced).alias("p")).select("row", F.lit(1).alias("kind"), "p.*")
    )
    files = flat.where("file").where(F.size("words") > 0).select(
        "row", F.lit(2).alias("kind"), F.lit(0).alias("place"), F.size("words").alias("size"), F.array(*map(F.lit, whole)).alias("numbers"), "words")
    return lines.unionByName(places).unionByName(files)


def scores(pages: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(row, template, score): the best template of each row that reaches the threshold.

    ``row`` holds the key and a digest of the text, so rows that share a key are told apart.
    """
    spark = pages.sparkSession
    file = F.coalesce(file_name(F.col(path)).rlike(FILES) & F.col(path).contains("/"), F.lit(False)) if path else F.lit(False)
    cut = pages.select(
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("digest")).alias("row"), file.alias("file"),
        F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "<[^>]*>", "\n").alias("bare"))
    vocabulary = spark.createDataFrame([("",), *((w,) for w in sorted({w for _, t, _, _ in templates() for w in t}))], "word string")
    # the empty word stands for the line itself
    seen = (
        cut.select(F.explode(F.split("bare", "[\r\n]+")).alias("line")).select(words(F.col("line")).alias("words")).where(F.size("words") > 0)
        .select(F.explode(F.array_append(F.array_distinct("words"), F.lit(""))).alias("word"))
    )
    counts = {r["word"]: r["df"] for r in seen.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("df")).collect()}
    idf, rare = weights(counts, counts.get("", 0))
    vectors = shares(idf)
    of_word: dict[str, list[tuple[int, float]]] = {w: [] for w in idf}
    for number, vector in enumerate(vectors):
        for w, x in vector.items():
            of_word[w].append((number, x))
    known = spark.createDataFrame([(w, idf[w], v) for w, v in of_word.items()], "word string, idf double, shares array<struct<number: int, share: double>>")
    licenses = F.array(*(F.lit(t) for t, _, _, _ in templates()))
    place = ["row", "kind", "place", "size", "numbers"]
    once = candidates(cut, vectors, counts).groupBy(*place).agg(F.first("words").alias("words"))
    weighted = (
        once.select(*place, F.explode("words").alias("word")).groupBy(*place, "word").agg(F.count("*").alias("n"))
        .join(F.broadcast(known), "word", "left")
        .withColumn("weight", (1 + F.log("n")) * F.coalesce("idf", F.lit(rare)))
    )
    # under number -1 the squared length
    own = F.filter(F.coalesce("shares", F.array().cast("array<struct<number: int, share: double>>")), lambda s: F.array_contains("numbers", s["number"]))
    terms = F.array_append(
        F.transform(own, lambda s: F.struct(s["number"].alias("number"), (s["share"] * F.col("weight")).alias("x"), F.lit(1).alias("hits"))),
        F.struct(F.lit(-1).alias("number"), (F.col("weight") * F.col("weight")).alias("x"), F.lit(0).alias("hits")))
    sums = weighted.select(*place, F.explode(terms).alias("t")).groupBy(*place, "t.number").agg(F.sum("t.x").alias("x"), F.sum("t.hits").alias("hits"))
    dots = (
        sums.groupBy(*place).agg(
            F.sqrt(F.max(F.when(F.col("number") < 0, F.col("x")))).alias("norm"),
            F.collect_list(F.when((F.col("number") >= 0) & (F.col("hits") > 1), F.struct("number", "x"))).alias("dots"))
        .select("row", "norm", F.explode("dots").alias("d"))
    )
    return (
        dots.select("row", licenses[F.col("d.number")].alias("template"), F.round(F.col("d.x") / F.col("norm"), 9).alias("score"))
        .where(F.col("score") >= THRESHOLD)
        .groupBy("row").agg(F.min_by(F.struct("template", "score"), F.struct(-F.col("score"), "template")).alias("best"))
        .select("row", "best.template", "best.score")
    )


def scan(pages: DataFrame, key: str = "page_id", path: str = "url", text: str = "html") -> DataFrame:
    """(key, path, license, score, origin): origin is ``own``, ``inherited`` or null."""
    ready(pages.sparkSession)
    found = materialize(scores(pages, key, text, path), "license-scores")
    rows = pages.select(
        F.col(key).alias("key"), F.col(path).alias("path"), directory(F.col(path)).alias("dir"),
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("digest")).alias("row"),
    )
    same = (F.col("row.key").eqNullSafe(F.col("r.key"))) & (F.col("row.digest") == F.col("r.digest"))
    own = materialize(
        rows.join(found.withColumnRenamed("row", "r"), same, "left").select("key", "path", "dir", "template", "score"), "own-licenses")
    grants = (
        own.where(F.col("template").isNotNull() & F.col("dir").isNotNull() & file_name(F.col("path")).rlike(FILES))
        .groupBy("dir").agg(F.min_by(F.struct("template", "score"), F.struct(-F.col("score"), "template")).alias("granted"))
    )
    parts = F.split("dir", "/")
    bare = own.where(F.col("template").isNull() & F.col("dir").isNotNull())
    above = (
        bare.select("dir").distinct()
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts))))
        .select(F.col("dir").alias("below"), "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("dir"))
    )
    inherited = (
        above.join(grants, "dir").groupBy(F.col("below").alias("dir"))
        .agg(F.max_by("granted", "depth").alias("granted"))
    )
    return own.join(inherited, "dir", "left").select(
        F.col("key").alias(key), F.col("path").alias(path),
        F.coalesce("template", "granted.template").alias("license"),
        F.coalesce("score", "granted.score").alias("score"),
        F.when(F.col("template").isNotNull(), "own").when(F.col("granted").isNotNull(), "inherited").alias("origin"),
    )
