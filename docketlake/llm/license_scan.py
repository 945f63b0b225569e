"""License scans: MinHash bands retrieve templates, exact containment verifies. DataFrame
functions only.

Templates fall into classes by length. A document is cut into overlapping windows long enough
that any stretch as long as a template of the class lies whole in one of them. Window and
template meet when any of their band values agree. Bands have one row, and their number is
set for each class so that a window holding SHARE of a template's five-word shingles is
retrieved with probability of at least RECALL; exact shingle containment decides. A template
shorter than a shingle is one shingle of its own length, looked up at every place.
"""

from __future__ import annotations

from collections import Counter
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_table, table

SHINGLE = 5
SHARE = 0.75
RECALL = 0.9999

# Public notices and the opening or grant of public licenses, by which texts name
# their license.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0 license.", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "All-Rights-Reserved": ["All rights reserved."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def _words_of(text: str) -> list[str]:
    import re

    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _class(n: int) -> int:
    c = 8
    while c < n:
        c *= 2
    return c


def _stride(c: int) -> int:
    return c // 4


def bands(c: int, lengths: list[int]) -> int:
    """Bands of class c: enough for the shortest template, at the least overlap that verifies."""
    worst = 1.0
    for n in lengths:
        s = n - SHINGLE + 1
        need = ceil(SHARE * s)
        worst = min(worst, need / (s + c + _stride(c) - SHINGLE + 1 - need))
    return ceil(log(1 - RECALL) / log(1 - worst)) if worst < 1 else 1


def _hitting(templates: list[list[str]]) -> list[str]:
    """Word pairs such that any SHARE of a template's shingles hold one: so many shingles of
    each template hold a pair that the rest is too few to verify. Greedily, of the pairs with the
    longest word, which are rare in other texts, the one that settles most."""
    left = []  # of each template: the pairs of its shingles that hold none yet, and how many must
    for w in templates:
        shingles = {tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}
        pairs = [{f"{a} {b}" for a, b in zip(s, s[1:])} for s in sorted(shingles)]
        left.append((pairs, len(pairs) - ceil(SHARE * len(pairs)) + 1))
    out: list[str] = []
    while left:
        count = Counter(p for shingles, _ in left for s in shingles for p in s)
        out.append(max(count, key=lambda p: (min(8, max(map(len, p.split()))), count[p], len(p), p)))
        rest = [([s for s in shingles if out[-1] not in s], more - sum(out[-1] in s for s in shingles)) for shingles, more in left]
        left = [(shingles, more) for shingles, more in rest if more > 0]
    return out


def _may_hold(text: Column, pairs: list[str], short: list[list[str]]) -> Column:
    """Whether a text holds the words of any pair, or all words of a short template, be it
    within others: tells of most texts at the cost of a few searches that they match nothing."""
    long = {}
    for p in pairs:
        long.setdefault(max(p.split(), key=len), set()).add(min(p.split(), key=len))
    out = F.lit(False)
    for word, others in sorted(long.items()):
        near = F.lit(False)
        for other in sorted(others):
            near = near | F.contains(text, F.lit(other))
        out = out | (F.contains(text, F.lit(word)) & near)
    for words in short:
        held = F.lit(True)
        for word in sorted(words, key=len, reverse=True):
            held = held & F.contains(text, F.lit(word))
        out = out | held
    return out


def _shingles(w: Column) -> Column:
    n = F.size(w)
    return F.array_distinct(F.transform(F.when(n >= SHINGLE, F.sequence(F.lit(0), n - SHINGLE)).otherwise(F.array().cast("array<int>")), lambda i: F.concat_ws(" ", F.slice(w, i + 1, F.lit(SHINGLE)))))


def _band_rows(shingles: Column, n: Column) -> Column:
    """(k, least hash of the shingles under the k-th hash function)"""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("k"), F.array_min(F.transform(shingles, lambda s: F.xxhash64(k, s))).alias("v")))


def _places(at: Column, c: int, n: int) -> Column:
    """(c, n, start, length) of the windows of class c that hold any of the given words."""
    s, length = _stride(c), c + _stride(c)
    near = F.transform(at, lambda i: F.sequence(F.greatest(F.lit(0), F.ceil((i - length + 1) / s)).cast("int"), F.floor(i / s).cast("int")))
    return F.transform(F.array_distinct(F.flatten(near)), lambda q: F.struct(F.lit(c).alias("c"), F.lit(n).alias("n"), (q * s).alias("start"), F.lit(length).alias("length")))


def _short_places(w: Column, words: list[str]) -> Column:
    """(c, n, start, length) of the places where a template shorter than a shingle stands."""
    held = F.size(w) >= len(words)
    for x in words:
        held = held & F.array_contains(w, x)
    at = F.sequence(F.lit(0), F.size(w) - len(words))

    def same(i: Column) -> Column:
        out = F.get(w, i) == words[0]
        for k, x in enumerate(words[1:], 1):
            out = out & (F.get(w, i + k) == x)
        return out

    place = lambda i: F.struct(F.lit(0).alias("c"), F.lit(1).alias("n"), i.alias("start"), F.lit(len(words)).alias("length"))
    return F.when(held, F.transform(F.filter(at, same), place)).otherwise(F.array().cast("array<struct<c:int,n:int,start:int,length:int>>"))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, license, containment (thousandths, highest), start_word (of the first such window).

    One row for each document and license found. Null, blank and short texts match nothing;
    rows with the same id and text give one row, other rows with a repeated or null id are
    scanned apart. Templates without words match nothing. Extra columns are ignored.
    """
    spark = docs.sparkSession
    known = [(name, t, _words_of(t)) for name, ts in (templates or TEMPLATES).items() for t in ts]
    short = [(name, w) for name, _, w in known if 0 < len(w) < SHINGLE]
    known = [(name, t, w) for name, t, w in known if len(w) >= SHINGLE]
    classes: dict[int, list[int]] = {}
    for _, _, w in known:
        classes.setdefault(_class(len(w)), []).append(len(w))
    size = {c: bands(c, n) for c, n in classes.items()}
    pairs = _hitting([w for _, _, w in known])
    hits, firsts = (F.array(*map(F.lit, x)).cast("array<string>") for x in (pairs, sorted({p.split()[0] for p in pairs})))
    bank_row = lambda name, c, n, w: F.struct(F.lit(name).alias("license"), F.lit(c).alias("c"), F.lit(n).alias("n"), F.array(*map(F.lit, w)).alias("w"))
    rows = F.array(*[bank_row(name, 0, 1, w) for name, w in short], *[bank_row(name, _class(len(w)), size[_class(len(w))], w) for name, _, w in known])
    bank = spark.range(1).select(F.inline(rows)).withColumn("t", F.when(F.col("c") == 0, F.array(F.concat_ws(" ", "w"))).otherwise(_shingles(F.col("w"))))
    bank = bank.select("license", "c", "t", F.inline(_band_rows(F.col("t"), F.col("n"))))

    # what verifies holds a pair of the hitting set, so windows without one match nothing; no
    # filter stands on these arrays, as it would compute them a second time
    shorts = sorted({tuple(x) for _, x in short})
    lower = F.lower(F.coalesce("text", F.lit("")))
    w = F.filter(F.split(lower, r"[^\p{L}\p{N}]+"), lambda x: x != "")
    d = docs.where(_may_hold(lower, pairs, shorts)).select("doc_id", F.xxhash64("doc_id", "text").alias("_row"), w.alias("w"))
    is_hit = lambda x, i: F.when(F.array_contains(firsts, x), F.array_contains(hits, F.concat_ws(" ", x, F.get("w", i + 1))))
    d = d.withColumn("at", F.filter(F.transform("w", lambda x, i: F.when(is_hit(x, i), i)), lambda i: i.isNotNull()))
    d = d.select("doc_id", "_row", "w", F.inline(F.concat(*[_short_places(F.col("w"), x) for x in shorts], *[_places(F.col("at"), c, n) for c, n in size.items()])))
    window = F.slice("w", F.col("start") + 1, F.col("length"))
    d = d.select("doc_id", "_row", "c", "n", "start", F.when(F.col("c") == 0, F.array(F.concat_ws(" ", window))).otherwise(_shingles(window)).alias("s"))
    d = d.select("doc_id", "_row", "c", "start", "s", F.inline(_band_rows(F.col("s"), F.col("n"))))
    # the bank is bounded by the templates given, whatever the corpus holds
    found = d.join(F.broadcast(bank), ["c", "k", "v"]).select("doc_id", "_row", "license", "start", F.floor(1000 * F.size(F.array_intersect("s", "t")) / F.size("t")).alias("share")).where(F.col("share") >= int(1000 * SHARE))
    best = found.groupBy("doc_id", "_row", "license").agg(F.max("share").alias("containment"), F.max(F.struct("share", (-F.col("start")).alias("at"))).alias("b"))
    return best.select("doc_id", "license", "containment", (-F.col("b.at")).alias("start_word"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
