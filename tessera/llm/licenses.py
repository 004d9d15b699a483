"""Licence scan: Dice coefficient over word bigrams against licence templates,
in built-in functions only.

A text is cut into segments: its lines, and its paragraphs (parts between blank
lines) of more than one line, so that notices of one line and whole licence texts
are both found.  A notice that shares its line or paragraph with other words is
found by windows over the words of the whole text.  A segment is normalised - lower case, every run of characters
other than a-z and 0-9 one space - and its distinct word bigrams are compared
with those of each template: Dice = 2 * common / (own + template's).

Windows: runs of bigrams that begin and end with a bigram of the template (other
ends can only lower the score) and are no longer than its size bound.  A start is
passed over when too few of the template's bigrams follow within the bound.  Of
each start the window with the most common bigrams counts (ties: the higher
score); windows are then taken in that order (ties: the earlier, the smaller name)
unless they share a word with one taken before, or with a matched line or
paragraph that holds as many common bigrams.

Candidates are pruned without losing any match at the threshold t:

* size bounds: Dice >= t needs t / (2 - t) * |T| <= |S| <= (2 - t) / t * |T|;
* of a template's |T| bigrams at most ``miss = |T| - ceil(t * (|T| + low) / 2)``
  may be absent (``low`` = smallest size allowed), so a segment must hold one of
  any ``miss + 1`` of them (its anchors).  A text without the longer word of any
  anchor (for very short words: without the anchor) is passed over after plain
  tests of the whole text; the others are cut into
  segments, whose normalised text is tested for the anchors by one regular
  expression before it is cut into words.

The templates are a fixed list or the caller's; their number and size are part
of the plan, so nothing is broadcast, joined or shuffled.

Nulls: a null text has no segment.  Ties between templates go to the smaller
name; repeated rows are scanned each; very long texts need no special rule; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, require

THRESHOLD = 0.8
BREAK = r"\n[ \t\r]*\n"

#: Licence notices (fixed values).
TEMPLATES = {
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-notice": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Proprietary": "All rights reserved. No part of this work may be reproduced without permission.",
}


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised text, in order."""
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def anchors(template: list[str], threshold: float) -> list[str]:
    """Bigrams of which every match holds one (see module text): the longest ones."""
    low, _ = size_bounds(len(template), threshold)
    miss = len(template) - math.ceil(threshold * (len(template) + low) / 2 - 1e-9)
    return sorted(template, key=lambda b: (-len(b), b))[:miss + 1]


def normalise(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, unit, segment, license, score)``: the best template of every
    segment that reaches the threshold.  ``unit`` is 'line', 'paragraph' or
    'window'; ``segment`` counts lines and paragraphs from 1 and is the number of a
    window's first word in the text, from 1."""
    require(docs, id_col, text_col)
    sets = {name: bigrams(t) for name, t in sorted((templates or TEMPLATES).items())}
    sets = {name: s for name, s in sets.items() if s}
    t = F.col(text_col).cast("string")
    blocks = F.transform(F.split(t, BREAK), lambda p: F.when(F.contains(p, F.lit("\n")), p))
    tests = sorted({a for s in sets.values() for a in anchors(s, threshold)}) or ["(?!)"]
    anchor = " (?:" + "|".join(tests) + ") "
    words = {a: max(a.split(" "), key=len) for a in tests}
    longer = {w for w in words.values() if len(w) > 3}
    longer = sorted(w for w in longer if not any(v != w and v in w for v in longer))  # 'license' stands for 'licensed'
    short = "|".join(a.replace(" ", "[^a-z0-9]+") for a, w in words.items() if len(w) <= 3)

    def able_text(low: Column) -> Column:
        checks = [F.contains(low, F.lit(w)) for w in longer] + ([low.rlike(short)] if short else [])
        return functools.reduce(operator.or_, checks)

    # the lower-cased text is an array's only element, so that it is made once for all tests
    able = docs.where(F.exists(F.array(F.lower(t)), able_text))

    def tagged(unit: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(unit).alias("unit"), i.alias("at"), p.alias("raw")))

    def pairs(w):
        cut = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1),
                         lambda a, b: F.concat_ws(" ", a, b))
        return F.when(F.size(w) > 1, cut).otherwise(F.array().cast("array<string>"))

    def match(own):
        found = []
        for name, s in sets.items():
            low, high = size_bounds(len(s), threshold)
            common = F.size(F.array_intersect(own, F.array(*map(F.lit, s))))
            found.append(F.when(F.size(own).between(low, high), F.struct(
                (-2.0 * common / (F.size(own) + len(s))).alias("rank"), F.lit(name).alias("license"),
                common.alias("common"))))
        return F.array_min(F.filter(F.array(*found), lambda x: x["rank"] <= -threshold))

    def segment_match(x):
        norm = normalise(x["raw"])
        best = let(norm, lambda n: F.when(
            F.concat(F.lit(" "), n, F.lit(" ")).rlike(anchor),
            let(let(F.split(n, " "), lambda w: F.array_distinct(pairs(w))), match)))
        return F.struct(x["unit"].alias("unit"), x["at"].alias("at"), best.alias("best"))

    def count_words(raw):
        return let(normalise(raw), lambda n: F.when(n == "", 0).otherwise(F.size(F.split(n, " "))))

    def starts_of(parts):
        """Words of the whole text before each part, and in the end all words: a mark
        per part among its words, whose places are counted in one pass."""
        marks = F.flatten(F.transform(F.concat(parts, F.array(F.lit(""))), lambda raw: F.concat(
            F.array(F.lit(True)), F.array_repeat(F.lit(False), count_words(raw)))))
        at = F.filter(F.transform(marks, lambda mark, j: F.when(mark, j)), lambda j: j.isNotNull())
        return F.transform(at, lambda j, i: j - i)

    def places(held):
        """First and last word of every matched line or paragraph, in the whole text."""
        def place(x, lines, blocks):
            def bound(i):
                return F.when(x["unit"] == "line", F.get(lines, i)).otherwise(F.get(blocks, i))

            return F.struct(bound(x["at"]).alias("first"), (bound(x["at"] + 1) - 1).alias("last"),
                            x["best"]["common"].alias("common"))

        return let(starts_of(F.split(t, "\n")), lambda lines: let(starts_of(F.split(t, BREAK)), lambda blocks: (
            F.transform(held, lambda x: place(x, lines, blocks)))))

    def windows(b):
        """The best window of every template from each of its starts (see module text)."""
        hits = F.filter(F.transform(b, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                        lambda h: h["x"].isin(sorted(set().union(*sets.values()))))
        return let(hits, lambda h: F.concat(*[of_template(b, h, name, s) for name, s in sets.items()]))

    def of_template(b, hits, name, s):
        low, high = size_bounds(len(s), threshold)
        least = max(1, math.ceil(threshold * (len(s) + low) / 2 - 1e-9))

        def from_start(p, k):
            first = F.get(p, k)["i"]

            def until(j):
                last = F.get(p, j)["i"]
                common = F.size(F.array_distinct(F.transform(F.slice(p, k + 1, j - k + 1), lambda x: x["x"])))
                own = F.size(F.array_distinct(F.slice(b, first + 1, last - first + 1)))
                return let(F.struct(common.alias("c"), own.alias("o")), lambda n: F.when(
                    n["o"].between(low, high) & (2.0 * n["c"] / (n["o"] + len(s)) >= threshold),
                    F.struct((-n["c"]).alias("common"), (-2.0 * n["c"] / (n["o"] + len(s))).alias("rank"),
                             first.alias("first"), (last + 1).alias("last"), F.lit(name).alias("license"))))

            ends = F.filter(F.sequence(k + least - 1, F.least(k + high, F.size(p)) - 1),
                            lambda j: F.get(p, j)["i"] - first < high)
            return F.array_min(F.filter(F.transform(ends, until), lambda x: x.isNotNull()))

        def starts(p):
            able = F.filter(F.sequence(F.lit(0), F.size(p) - least),
                            lambda k: F.get(p, k + least - 1)["i"] - F.get(p, k)["i"] < high)
            return F.when(F.size(p) >= least, F.filter(
                F.transform(able, lambda k: from_start(p, k)), lambda x: x.isNotNull()))

        none = F.array().cast("array<struct<common:int,rank:double,first:int,last:int,license:string>>")
        return F.coalesce(let(F.filter(hits, lambda h: h["x"].isin(s)), starts), none)

    def apart(found, held):
        """Windows in order of rank that share no word with a better one, nor with
        a line or paragraph that holds as much."""
        def add(taken, x):
            clash = F.exists(taken, lambda y: (y["first"] <= x["last"]) & (x["first"] <= y["last"]))
            return F.when(clash, taken).otherwise(F.concat(taken, F.array(x)))

        free = F.filter(found, lambda x: ~F.exists(held, lambda y: (
            (y["first"] <= x["last"]) & (x["first"] <= y["last"]) & (y["common"] >= -x["common"]))))
        return F.aggregate(F.array_sort(free), F.slice(found, 1, 0), add)

    if not sets:
        return docs.where(F.lit(False)).select(
            F.col(id_col).alias("doc_id"), F.lit("").alias("unit"), F.lit(0).alias("segment"),
            F.lit("").alias("license"), F.lit(0.0).alias("score"))
    parts = F.filter(F.concat(tagged("line", F.split(t, "\n")), tagged("paragraph", blocks)),
                     lambda x: x["raw"].isNotNull())
    # plan nodes of their own, so that each step is evaluated once
    whole = let(normalise(t), lambda n: F.when(
        F.concat(F.lit(" "), n, F.lit(" ")).rlike(anchor), let(let(F.split(n, " "), pairs), windows)))
    row = able.select(F.col(id_col).alias("doc_id"), t.alias("_text"), whole.alias("found"), F.filter(
        F.transform(parts, segment_match), lambda x: x["best"].isNotNull()).alias("held"))
    t = F.col("_text")
    row = row.where((F.size("found") > 0) | (F.size("held") > 0)).select(
        "doc_id", "found", "held", F.when(F.size("held") > 0, places(F.col("held"))).otherwise(
            F.array().cast("array<struct<first:int,last:int,common:int>>")).alias("places"))
    rest = F.when(F.size("found") > 0, apart(F.col("found"), F.col("places")))
    out = F.concat(
        F.transform("held", lambda x: F.struct(
            x["unit"].alias("unit"), (x["at"] + 1).alias("segment"), x["best"]["license"].alias("license"),
            (-x["best"]["rank"]).alias("score"))),
        F.coalesce(F.transform(rest, lambda x: F.struct(
            F.lit("window").alias("unit"), (x["first"] + 1).alias("segment"), x["license"].alias("license"),
            (-x["rank"]).alias("score"))), F.array().cast(
                "array<struct<unit:string,segment:int,license:string,score:double>>")))
    return row.select("doc_id", F.explode(out).alias("x")).select("doc_id", "x.*")


def oracle_sql(table: str = "documents", threshold: float = THRESHOLD) -> str:
    """DuckDB SQL that compares every segment with every template, unpruned."""
    values = ", ".join(f"('{n}', {bigrams(t)!r})" for n, t in sorted(TEMPLATES.items()))
    return f"""
WITH tpl(license, t) AS (VALUES {values}),
seg AS (
  SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS segment FROM documents
  UNION ALL
  SELECT doc_id, 'paragraph', unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')),
         unnest(range(1, len(string_split_regex(text, '\\n[ \\t\\r]*\\n')) + 1)) FROM documents),
norm AS (
  SELECT doc_id, unit, segment, string_split(trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM seg WHERE unit = 'line' OR contains(raw, chr(10))),
own AS (
  SELECT doc_id, unit, segment, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS o FROM norm),
scored AS (
  SELECT doc_id, unit, segment, license,
         2.0::DOUBLE * len(list_intersect(o, t)) / (len(o) + len(t)) AS score FROM own, tpl)
SELECT doc_id, unit, CAST(segment AS INTEGER) AS segment, license, score FROM scored WHERE score >= {threshold}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, segment ORDER BY score DESC, license) = 1
""".replace("documents", table)
