"""Licence scan: Dice coefficient over word bigrams (native).

A document's lines, the whole text where it has several lines, and windows of as
many words as a template has, over line ends, are compared with licence templates.
A window lies where a word pair that holds one of the template's needed words is in
its place; it counts where no line in it, nor the whole text, matches the licence. The comparison is by sets of word bigrams of normalised
text; a template can only match a unit whose number of bigrams is within
``t / (2 - t)`` of its own, and only if the unit has one of a few words of the
template without which too few bigrams are left. Both bounds are exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: licence notices (identifier, text); headers as published by the
# licences' stewards, and short forms in common use
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)

def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def needed_words(texts: list[str], least: float) -> list[str]:
    """Words of which a match with any of ``texts`` must hold one: without them a
    template keeps fewer than ``least`` of its bigrams. Words that other templates
    need are taken first, then those in most bigrams."""
    chosen: list[str] = []
    for text in sorted(texts, key=lambda t: len(bigrams_of(t))):
        left = bigrams_of(text)
        need = least * len(left)
        left = [b for b in left if not set(chosen) & set(b.split())]
        while len(left) >= need:
            gain = {w: sum(w in b.split() for b in left) for w in set(words_of(text)) - set(chosen)}
            w = max(gain, key=lambda x: (gain[x] > 0 and len(x) > 4, gain[x], len(x), x))
            chosen.append(w)
            left = [b for b in left if w not in b.split()]
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
         templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Matches (doc_id, line, license_id, dice): one row per matching unit and
    licence, with the best coefficient of the licence's templates. ``line``
    counts from 1; 0 is the whole text of a document of several lines. A window
    is named by the line it begins in; of windows that overlap the best counts.

    Units of fewer than two words have no bigrams and match nothing; null and
    empty texts match nothing. Null ids are kept; repeated rows are scanned one by
    one; an empty table gives an empty result; other columns are ignored.
    """
    low = threshold / (2 - threshold)
    data = [(lid, bigrams_of(text)) for lid, text in templates]
    anchors = needed_words([text for _, text in templates], low)

    def some(text: str) -> Column:
        # one lower-case copy per row, shared by all the searches in it
        return F.exists(F.array(F.lower(text)), lambda x: reduce(lambda a, b: a | b, [x.contains(w) for w in anchors]))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(some("text"))
    lines = F.split("text", "\n")
    units = F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(F.concat(F.array(F.lit(None).cast("string")), lines))
    units = F.transform(units, lambda u, i: F.struct(i.alias("line"), u.alias("unit"), F.lit(None).cast("string").alias("only")))
    rows = _windows(rows.withColumn("units", units), templates, anchors, low, threshold)
    rows = rows.select("doc_id", F.explode(F.concat("units", "windows")).alias("u")).select("doc_id", "u.*").filter("unit is not null")
    rows = rows.filter(some("unit")).withColumn("words", F.split(normalised(F.col("unit")), " "))
    rows = rows.filter(F.size("words") > 1).withColumn("grams", _pairs(F.col("words")))
    rows = rows.select("doc_id", "line", "only", F.explode(_hits(F.col("grams"), data, low, threshold)).alias("hit")).filter("only is null or only = hit.license_id")
    return rows.select("doc_id", "line", "hit.license_id", "hit.dice")


def _windows(rows: DataFrame, templates: tuple[tuple[str, str], ...], anchors: list[str], low: float, threshold: float) -> DataFrame:
    """``rows`` with the matching windows, as ``units`` are."""
    data = [(lid, bigrams_of(text)) for lid, text in templates]
    places = []  # of the word pairs that a match must have one of
    for _, text in templates:
        w = words_of(text)
        places.append([(f"{a} {b}", p) for p, (a, b) in enumerate(zip(w, w[1:], strict=False)) if any(x in a or x in b for x in anchors)])
    wanted = sorted({g for some in places for g, _ in some})
    words = F.transform(F.split("text", "\n"), lambda x: F.filter(F.split(normalised(x), " "), lambda w: w != ""))
    rows = rows.withColumn("_lines", words).withColumn("_words", F.flatten("_lines"))
    rows = rows.withColumn("_line", F.flatten(F.transform("_lines", lambda x, i: F.array_repeat(i + 1, F.size(x)))))
    pair = F.zip_with(F.slice("_words", 1, F.greatest(F.size("_words") - 1, F.lit(0))), F.slice("_words", 2, F.size("_words")), lambda a, b: F.concat_ws(" ", a, b))
    rows = rows.withColumn("_at", F.filter(F.transform(pair, lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda x: x["g"].isin(wanted)))
    found = []
    for (lid, grams), some, (_, text) in zip(data, places, templates, strict=True):
        n = len(words_of(text))
        where = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(p).alias("p")) for g, p in some])
        all_starts = F.array_distinct(F.flatten(F.transform("_at", _starts(where))))
        found.append(F.filter(F.transform(all_starts, _window(lid, grams, n, low)), lambda x: x["dice"] >= threshold))
    rows = rows.withColumn("_found", F.concat(*found))

    def beaten(x: Column, y: Column) -> Column:
        first = (y["start"] < x["start"]) | (y["start"] == x["start"]) & (y["end"] > x["end"])
        return (y["lid"] == x["lid"]) & (y["start"] < x["end"]) & (x["start"] < y["end"]) & ((y["dice"] > x["dice"]) | (y["dice"] == x["dice"]) & first)

    best = F.filter("_found", lambda x: ~F.exists("_found", lambda y: beaten(x, y)))
    rows = rows.withColumn("_best", best)

    def known(u: Column) -> Column:
        own = F.array(_pairs(F.split(normalised(F.coalesce(u["unit"], F.lit(""))), " ")))
        hits = F.transform(own, lambda g: _hits(g, data, low, threshold))[0]
        return F.transform(hits, lambda h: F.struct(u["line"].alias("line"), h["license_id"].alias("lid")))

    rows = rows.withColumn("_known", F.when(F.size("_best") > 0, F.flatten(F.transform("units", known))))

    def again(x: Column, k: Column) -> Column:
        lines = k["line"].between(F.get("_line", x["start"]), F.get("_line", x["end"] - 1))
        return (k["lid"] == x["lid"]) & ((k["line"] == 0) | lines)

    new = F.filter("_best", lambda x: ~F.exists("_known", lambda k: again(x, k)))
    shape = F.transform(new, lambda x: F.struct(F.get("_line", x["start"]).alias("line"),
                                                F.concat_ws(" ", F.slice("_words", x["start"] + 1, x["end"] - x["start"])).alias("unit"), x["lid"].alias("only")))
    return rows.withColumn("windows", shape)


def _starts(where: Column) -> Callable[[Column], Column]:
    return lambda x: F.transform(F.filter(where, lambda o: o["g"] == x["g"]), lambda o: F.greatest(x["i"] - o["p"], F.lit(0)))


def _window(lid: str, grams: list[str], n: int, low: float) -> Callable[[Column], Column]:
    def window(start: Column) -> Column:
        own = F.array(_pairs(F.slice("_words", start + 1, n)))
        dice = F.transform(own, lambda g: _dice(grams, low, g))[0]
        return F.struct(F.lit(lid).alias("lid"), start.alias("start"), F.least(start + n, F.size("_words")).alias("end"), dice.alias("dice"))

    return window


def _pairs(words: Column) -> Column:
    """Distinct bigrams; none of fewer than two words."""
    both = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(both)


def _hits(grams: Column, data: list[tuple[str, list[str]]], low: float, threshold: float) -> Column:
    scores = []
    for lid in dict.fromkeys(lid for lid, _ in data):
        of = [_dice(g, low, grams) for each, g in data if each == lid]
        scores.append(F.struct(F.lit(lid).alias("license_id"), (F.greatest(*of) if len(of) > 1 else of[0]).alias("dice")))
    return F.filter(F.array(*scores), lambda s: s["dice"] >= threshold)


def _dice(grams: list[str], low: float, own: Column) -> Column:
    """Null where the numbers of bigrams rule a match out."""
    both = F.size(F.array_intersect(own, F.array(*[F.lit(g) for g in grams])))
    n = F.size(own)
    fits = (n >= low * len(grams)) & (n * low <= len(grams))
    return F.when(fits, 2.0 * both / (n + len(grams)))
