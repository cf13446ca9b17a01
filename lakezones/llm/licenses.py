"""License scan: Dice coefficient over word bigrams against licence templates.

Texts are normalised to lower-case words, and a notice is any run of a text's words, within a
line or across lines, whose bigrams have a Dice coefficient of at least t with those of a template.
Bigrams count as often as they occur.  Size bounds prune before anything is compared: with sizes a (window) and
b (template), a lies in [b t / (2 - t), b (2 - t) / t] and the overlap is at least b t / (2 - t).  So

* a text that has fewer of a template's bigrams than that is no candidate for it;
* a window starts only where that many of them lie within the greatest size;
* the best window begins and ends with a bigram of the template, as others only make it longer.

A bigram that a template has c times counts in a window if its c-th last occurrence lies before the window;
the overlap of all windows from one start is then a running count.  DataFrame functions only, no shuffle but the
one that groups the findings.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Texts of public licence notices.
TEMPLATES: dict[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip(" ").split(" ")


def template_bigrams(text: str) -> Counter:
    w = words_of(text)
    return Counter(f"{a} {b}" for a, b in zip(w, w[1:]))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_sizes(b: int, threshold: float) -> tuple[int, int]:
    """Least and greatest number of bigrams of a window that can reach the threshold with a template of ``b`` bigrams.

    The least is also the least overlap.
    """
    return math.ceil(b * threshold / (2 - threshold) - 1e-9), math.floor(b * (2 - threshold) / threshold + 1e-9)


def _last_seen(hits: Column) -> Column:
    """Hits (gram, pos, c) as (pos, seen) by place: ``seen`` is where the gram was c occurrences ago, or -1."""
    def seen(by_gram: Column, x: Column, i: Column) -> Column:
        before = F.get(by_gram, i - x["c"])
        return F.struct(x["pos"].alias("pos"),
                        F.when(before["gram"] == x["gram"], before["pos"]).otherwise(F.lit(-1)).alias("seen"))

    return F.array_sort(_let(F.array_sort(hits), lambda s: F.transform(s, lambda x, i: seen(s, x, i))))


def _best_windows(hits: Column, b: Column, least: Column, most: Column, threshold: float) -> Column:
    """For every start that can: its window of the highest Dice (the shortest of equals) as (dice, end, start), if it reaches the threshold."""
    def best(at: Column, x: Column, i: Column) -> Column:
        start = x["pos"]
        counted = F.filter(F.slice(at, i + 1, most), lambda y: (y["pos"] < start + most) & (y["seen"] < start))
        scores = F.transform(counted, lambda y, j: F.struct(
            (F.lit(2.0) * (j + 1) / (y["pos"] - start + 1 + b)).alias("dice"), (-y["pos"]).alias("end"), start.alias("start")))
        dense = F.get(at, i + least - 1)["pos"] - start < most
        return F.when(dense, F.array_max(scores))

    return F.filter(F.transform(hits, lambda x, i: best(hits, x, i)), lambda w: w["dice"] >= threshold)


def _places(windows: Column) -> Column:
    """Number of places: windows that overlap are one."""
    none = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("reach"))
    return F.aggregate(windows, none, lambda a, w: F.struct(
        (a["n"] + F.when(w["start"] > a["reach"], 1).otherwise(0)).alias("n"),
        F.greatest(a["reach"], -w["end"]).alias("reach")))["n"]


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Licences found: one row per ``doc_id`` and ``license`` with ``dice`` (the best) and ``n_segments``, the number of places.

    A notice may stand inside a line, beside other text or across lines of any line end; a short notice
    within a longer one is found as well.  Null and empty texts, and templates of fewer than two words, match nothing.  Rows
    that share a doc_id are one document, but no notice crosses rows; a null doc_id is kept.  Other columns are ignored.
    """
    grams = {k: template_bigrams(t) for k, t in sorted(templates.items())}
    grams = {k: g for k, g in grams.items() if g and "" not in words_of(templates[k])}
    if not grams:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("dice"),
                           F.lit(0).cast("long").alias("n_segments")).where("false")
    known = sorted(set().union(*grams.values()))
    words = F.split(F.lower("text"), "[^a-z0-9]+", -1)  # empty ones, at the ends only, are in no known bigram
    pairs = _let(words, lambda w: F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1),
                                             lambda a, b: F.concat(a, F.lit(" "), b)))
    marked = F.transform(pairs, lambda g, i: F.when(g.isin(known), F.struct(g.alias("gram"), i.alias("pos"))))
    hits = docs.where("text is not null").select("doc_id", F.explode(F.array(F.filter(marked, lambda x: x.isNotNull()))).alias("_hits"))
    found = []
    for name, g in grams.items():
        b = sum(g.values())
        least, most = window_sizes(b, threshold)
        count = _count_of(g)
        own = F.transform(F.filter("_hits", lambda x: x["gram"].isin(sorted(g))),
                          lambda x: F.struct(x["gram"].alias("gram"), x["pos"].alias("pos"), count(x["gram"]).alias("c")))
        found.append(F.when(F.size("_hits") >= least, F.struct(F.lit(name).alias("license"), F.lit(b).alias("b"), F.lit(least).alias("least"),
                                                               F.lit(most).alias("most"), own.alias("hits"))))
    near = (hits.select("doc_id", F.explode(F.filter(F.array(*found), lambda x: F.size(x["hits"]) >= x["least"])).alias("m"))
            .select("doc_id", "m.license", _let(_last_seen(F.col("m.hits")), lambda h: _best_windows(
                h, F.col("m.b"), F.col("m.least"), F.col("m.most"), threshold)).alias("_windows")))
    return (near.where(F.size("_windows") > 0)
            .select("doc_id", "license", F.array_max("_windows")["dice"].alias("dice"), _places(F.col("_windows")).alias("_n"))
            .groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.sum("_n").alias("n_segments")))


def _count_of(bigrams: Counter):
    """How often the template has a bigram, as an expression of the bigram."""
    def count(gram: Column) -> Column:
        out = F.lit(1)
        for c in sorted(set(bigrams.values()) - {1}):
            out = F.when(gram.isin(sorted(g for g, n in bigrams.items() if n == c)), F.lit(c)).otherwise(out)
        return out

    return count


def license_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB SQL: all windows between two bigrams of a template, by a join."""
    rows, most_often = [], 1
    for name, text in sorted(templates.items()):
        g = template_bigrams(text)
        b = sum(g.values())
        rows += [f"('{name}', '{k}', {c}, {b}, {window_sizes(b, threshold)[1]})" for k, c in sorted(g.items())]
        most_often = max(most_often, *g.values())
    seen = " ".join(f"WHEN {c} THEN lag(pos, {c}) OVER p" for c in range(1, most_often + 1))
    return f"""
WITH t(license, gram, c, b, most) AS (VALUES {", ".join(rows)}),
words AS (SELECT row_number() OVER () AS rid, doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), ' ') AS w
          FROM documents WHERE text IS NOT NULL),
grams AS (SELECT rid, doc_id, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS gram,
            unnest(range(1, len(w))) AS pos FROM words),
hits AS (SELECT rid, doc_id, license, gram, pos, b, most, coalesce(CASE c {seen} END, -1) AS seen
         FROM grams JOIN t USING (gram) WINDOW p AS (PARTITION BY rid, license, gram ORDER BY pos)),
windows AS (SELECT x.rid, x.doc_id, x.license, x.pos AS s, y.pos AS e,
              2.0::DOUBLE * row_number() OVER (PARTITION BY x.rid, x.license, x.pos ORDER BY y.pos) / (y.pos - x.pos + 1 + x.b) AS dice
            FROM hits x JOIN hits y ON x.rid = y.rid AND x.license = y.license AND y.pos >= x.pos AND y.pos < x.pos + x.most AND y.seen < x.pos),
best AS (SELECT rid, doc_id, license, s, e, dice FROM windows WHERE dice >= {threshold}
         QUALIFY row_number() OVER (PARTITION BY rid, license, s ORDER BY dice DESC, e) = 1),
apart AS (SELECT doc_id, license, dice, CASE WHEN s > coalesce(max(e) OVER (PARTITION BY rid, license ORDER BY s
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS begins FROM best)
SELECT doc_id, license, max(dice) AS dice, sum(begins)::BIGINT AS n_segments FROM apart GROUP BY doc_id, license"""
