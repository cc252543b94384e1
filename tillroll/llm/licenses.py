"""License scan in DataFrame functions only: TF-IDF cosine of windows of words to templates, then inheritance by directory.

Every word of the corpus is weighed by how few lines have it.  A header may stand anywhere in a text, among other words
or wrapped over lines, so each template is compared with all windows of at most twice its words that begin and end at
words of its own; other ends only lower the cosine.  A window that has too little of a template's weight can't reach the
least cosine whatever else it holds, so only the others are joined with the weights of their remaining words.  Whole files
are compared with the texts of whole licenses in the same way.  A file that is such a text, or mostly consists of
headers, is a licence file, and files below its directory that name no license inherit from the nearest one above them.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_groups, stored

# fixed values: usual headers of licenses
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights, CC0 1.0.",
    "proprietary": "All rights reserved.",
}
#: More headers: other wordings and other licenses.
HEADERS = [
    ("Apache-2.0", "Apache License Version 2.0"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    *(
        (f"{short}-{n}", f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} General Public "
         f"License as published by the Free Software Foundation, either version {n.removesuffix('.0')} of the License, or (at your option) any later version.")
        for short, kind, what, versions in (("GPL", "", "program", ("2.0", "3.0")), ("LGPL", "Lesser", "library", ("2.1", "3.0")), ("AGPL", "Affero", "program", ("3.0",)))
        for n in versions
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    *((f"CC-{x.replace(' ', '-')}-4.0", f"Licensed under CC {x} 4.0.") for x in ("BY", "BY SA", "BY ND", "BY NC", "BY NC SA", "BY NC ND")),
    *(
        (f"CC-{x}-4.0", f"This work is licensed under a Creative Commons {long} 4.0 International License.")
        for x, long in (
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
]
#: Texts of whole licenses by name.
TEXTS = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
#: Least cosine of a match.
COSINE = 0.7
#: A window has at most so many times the words of its template.
REACH = 2
#: Names of templates that reserve rights, which count only where no license is named.
RESERVED = ("proprietary",)
_WORD = r"'[\\p{L}\\p{N}]+'"


def _texts(values) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def line_counts(rows: DataFrame) -> DataFrame:
    """w, lines: the number of lines of all texts that have the word; of the word '', the number of lines with words."""
    lines = f"filter(transform(split(text, '\\n'), l -> array_distinct(regexp_extract_all(lower(l), {_WORD}, 0))), w -> size(w) > 0)"
    words = rows.selectExpr(f"explode(flatten(transform({lines}, w -> concat(w, array(''))))) AS w")
    return stored(words.groupBy("w").agg(F.count("*").alias("lines")), "license-words")


def weigher(counts: DataFrame, words: set[str]) -> tuple[dict[str, float], str]:
    """Squared weights of ``words``, and SQL for that of any word seen in ``lines``."""
    asked = counts.sparkSession.createDataFrame([(w,) for w in sorted(words | {""})], "w string")
    seen = {r["w"]: r["lines"] for r in counts.join(F.broadcast(asked), "w").collect()}  # a row per word of the templates
    n = seen.get("", 0)
    return {w: max(1e-9, math.log((1 + n) / seen.get(w, 1)) ** 2) for w in words}, f"greatest(1e-9D, pow(ln({1 + n}D / lines), 2))"


def sums(asked: DataFrame, counts: DataFrame, weight: str, keys: list[str]) -> DataFrame:
    """``keys`` and the sum of the weights of the words in ``rest`` for each row of ``asked``, which has them distinct."""
    words = asked.select(*keys, F.explode("rest").alias("w"))
    told = stored(words.groupBy("w").agg(F.count("*").alias("uses")).join(counts, "w"), "license-weights")
    return join_groups(words, told, "w", "uses", keys[0]).groupBy(*keys).agg(F.expr(f"sum({weight})").alias("others"))


def prepared(templates: list[tuple[str, list[str]]], weights: dict[str, float], cosine: float) -> tuple[list[str], str]:
    """The templates as SQL structs, and all their keys: a window that matches has a key of the template."""
    told, every = [], set()
    for name, words in templates:
        own = sorted(set(words), key=lambda w: (weights[w], w))
        total = sum(weights[w] for w in own)
        need, light, n = cosine * cosine * total * (1 - 1e-9), 0.0, 0
        while n < len(own) and light + weights[own[n]] < need:  # these alone can't reach the least cosine
            light, n = light + weights[own[n]], n + 1
        heavy, least = 0.0, 0
        while heavy < need and least < len(own):  # fewer words can't reach it
            least, heavy = least + 1, heavy + weights[own[-1 - least]]
        every |= set(own[n:])
        told.append(
            f"named_struct('name', {_texts([name])}[0], 'words', {_texts(own)}, 'weights', array({', '.join(f'{weights[w]!r}D' for w in own)}), "
            f"'keys', {_texts(own[n:])}, 'reach', {REACH * len(words)}, 'total', {total!r}D, 'need', {need!r}D, 'least', {least})"
        )
    return told, _texts(sorted(every))


def headers(held: DataFrame, told: list[str], keys: str, longest: int, counts: DataFrame, weight: str, cosine: float) -> DataFrame:
    """row, taken: windows that match a template and that no better one overlaps, for rows of ``held`` (row, text).

    A window has at, end (numbers of words), line, end_line, score and name.
    """
    reach = REACH * longest
    tokens = f"flatten(transform(split(text, '\\n'), (l, i) -> transform(regexp_extract_all(lower(l), {_WORD}, 0), w -> named_struct('line', i, 'w', w))))"
    near = (
        held.filter("text IS NOT NULL").selectExpr("row", f"{tokens} AS tokens")
        .selectExpr(
            "row",
            f"inline(transform(filter(sequence(0, size(tokens) - 1), i -> array_contains({keys}, tokens[i].w)), i -> named_struct("
            f"'base', greatest(i - {reach}, 0), 'at', least(i, {reach}), 'part', slice(tokens, greatest(i - {reach}, 0) + 1, {2 * reach + 1}))))",
        )
    )
    placed = (
        near.selectExpr("*", f"explode(filter(array({', '.join(told)}), t -> array_contains(t.keys, part[at].w))) AS t")
        .selectExpr("*", "filter(sequence(greatest(at - t.reach + 1, 0), least(at + t.reach, size(part)) - 1), i -> array_contains(t.words, part[i].w)) AS own")
        # of the windows with several keys each is taken at its first one
        .selectExpr("*", "coalesce(array_max(filter(own, i -> i < at AND array_contains(t.keys, part[i].w))), -1) AS before")
        .selectExpr(
            "row", "base", "part", "t", "at AS key",
            "inline(flatten(transform(filter(own, s -> s <= at AND s > before), s -> transform(filter(own, e -> e >= at AND e - s < t.reach), e -> named_struct('s', s, 'e', e)))))",
        )
        .selectExpr("*", "array_distinct(slice(part, s + 1, e - s + 1).w) AS words")
        .selectExpr(
            "row", "t.name", "base + key AS key", "base + s AS at", "base + e + 1 AS end", "part[s].line AS line", "part[e].line AS end_line", "t.total", "t.need",
            "aggregate(array_intersect(words, t.words), 0D, (a, w) -> a + t.weights[array_position(t.words, w) - 1]) AS known",
            "array_except(words, t.words) AS rest",
        )
        .filter("known >= need")
    )
    windows = stored(placed, "license-windows")
    id_ = ["row", "name", "at", "end", "total"]
    scored = windows.join(sums(windows.filter("size(rest) > 0"), counts, weight, id_), id_, "left").selectExpr(
        "row", "name", "key", "at", "end", "line", "end_line", "round(known / sqrt((known + coalesce(others, 0D)) * total), 9) AS score"
    )
    best = scored.filter(f"score >= {cosine!r}D").groupBy("row", "key").agg(
        F.expr("max(struct(score, at - end AS shortness, name, at, end, line, end_line)) AS b")
    )
    return best.groupBy("row").agg(F.expr("reverse(array_sort(collect_list(b))) AS found")).selectExpr(
        "row",
        "aggregate(found, slice(found, 1, 0), (t, b) -> if(exists(t, x -> x.at < b.end AND b.at < x.end), t, concat(t, array(b)))) AS taken",
    )


def whole(files: DataFrame, told: list[str], counts: DataFrame, weight: str, cosine: float) -> DataFrame:
    """row, text_name, text_score: the license whose whole text is most similar to a file's, for rows of ``files`` (row, words)."""
    known = (
        files.filter("words IS NOT NULL")
        .selectExpr("row", "words", f"explode(filter(array({', '.join(told)}), t -> size(array_intersect(t.words, words)) >= t.least)) AS t")
        .selectExpr(
            "row", "t.name", "t.total", "t.need", "array_except(words, t.words) AS rest",
            "aggregate(array_intersect(words, t.words), 0D, (a, w) -> a + t.weights[array_position(t.words, w) - 1]) AS known",
        )
        .filter("known >= need")
    )
    near = stored(known, "license-texts")
    id_ = ["row", "name", "total"]
    return (
        near.join(sums(near.filter("size(rest) > 0"), counts, weight, id_), id_, "left")
        .selectExpr("row", "name", "round(known / sqrt((known + coalesce(others, 0D)) * total), 9) AS score")
        .filter(f"score >= {cosine!r}D").groupBy("row").agg(F.expr("max(struct(score, name)) AS b"))
        .selectExpr("row", "b.name AS text_name", "b.score AS text_score")
    )


def license_scan(
    files: DataFrame, templates: dict[str, str] = TEMPLATES, cosine: float = COSINE,
    more: list[tuple[str, str]] = HEADERS, texts: dict[str, str] = TEXTS,
) -> DataFrame:
    """Own and inherited license of every row of ``files``.

    ``files`` needs doc_id, path (directories by /) and text; other columns are ignored.  Null texts have no lines, null
    paths lie in the root directory "".  Repeated rows get a row each.  ``templates`` and ``more`` are headers, ``texts``
    whole licenses.  Returns doc_id, path, license (of the whole text, else of the most similar window, of equal ones the
    last by name), score, n_license_lines (lines that matching windows touch), is_license_file, inherited.
    """
    by_name = [(name, _words(text)) for name, text in [*templates.items(), *more]]
    by_text = [(name, sorted(set(_words(text)))) for name, text in texts.items()]
    rows = files.selectExpr("cast(doc_id AS long) AS doc_id", "coalesce(path, '') AS path", "coalesce(text, '') AS text")
    counts = line_counts(rows)
    weights, weight = weigher(counts, {w for _, words in by_name + by_text for w in words})
    told, keys = prepared(by_name, weights, cosine)
    told_texts, _ = prepared(by_text, weights, cosine)
    # a file needs so many words of a license at least
    every, least = _texts(sorted({w for _, words in by_text for w in words})), min((int(t[t.rindex("'least', ") + 9 : -1]) for t in told_texts), default=1)
    # numbered once: the stored numbers stay; texts without a key and words without a license's are never read again
    held = stored(
        rows.selectExpr("monotonically_increasing_id() AS row", "*", f"regexp_extract_all(lower(text), {_WORD}, 0) AS words").selectExpr(
            "row", "doc_id", "path", "size(words) AS n_words", f"if(arrays_overlap(words, {keys}), text, NULL) AS text", "array_distinct(words) AS words"
        ).withColumn("words", F.expr(f"if(size(array_intersect(words, {every})) >= {least}, words, NULL)")),
        "license-rows",
    )
    matched = stored(headers(held, told, keys, max(len(words) for _, words in by_name), counts, weight, cosine), "license-headers")
    named = matched.selectExpr(
        "row", f"array_max(transform(taken, b -> struct(b.name NOT IN ({', '.join(map(repr, RESERVED))}) AS named, b.score AS score, b.name AS name))) AS best",
        "cast(size(array_distinct(flatten(transform(taken, b -> sequence(b.line, b.end_line))))) AS long) AS n_license_lines",
        "aggregate(taken, 0, (n, b) -> n + b.end - b.at) AS covered",
    )
    texts_of = whole(held, told_texts, counts, weight, cosine) if by_text else held.selectExpr("row", "'' AS text_name", "0D AS text_score").limit(0)
    own = stored(
        held.drop("text", "words").join(named, "row", "left").join(texts_of, "row", "left").selectExpr(
            "doc_id", "path", "regexp_replace(path, '/?[^/]*$', '') AS directory",
            "coalesce(text_name, best.name) AS license", "coalesce(text_score, best.score) AS score", "coalesce(n_license_lines, 0L) AS n_license_lines",
            "text_name IS NOT NULL OR coalesce(2 * covered >= n_words, false) AS is_license_file",
        ),
        "license-own",
    )
    directories = stored(own.groupBy("directory").agg(F.count("*").alias("files")), "license-directories")
    above = directories.selectExpr(
        "directory",
        "explode(transform(sequence(0, size(split(directory, '/'))), i -> if(i = 0, '', array_join(slice(split(directory, '/'), 1, i), '/')))) AS ancestor",
    ).distinct()
    granted = own.filter("is_license_file").groupBy(F.col("directory").alias("ancestor")).agg(
        F.max_by("license", F.struct("score", "license")).alias("grant")
    )
    nearest = above.join(granted, "ancestor").groupBy("directory").agg(F.max_by("grant", F.length("ancestor")).alias("grant"))
    told = stored(directories.join(nearest, "directory", "left"), "license-grants")
    return join_groups(own, told, "directory", "files", "doc_id").selectExpr(
        "doc_id", "path", "license", "score", "n_license_lines", "is_license_file", "if(license IS NULL, grant, NULL) AS inherited"
    )
