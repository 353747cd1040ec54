"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Texts are cut into words (runs of letters and digits, lower-case) and hashed shingles of five words.  A template of n
words matches at a start if at least 0.8 of its shingles are among those of the next 2n words, so an occurrence may hold
as many inserted words as the template has.  Starts are the text's shingles that some template has: any other start loses
nothing if it moves on to the next of them, so the best of these is the best of all.

1. Templates fall into classes of similar length (a factor of 1.25).  A class cuts a text into overlapping windows, each
   ``stride`` starts and the 2n words behind the last; only windows with enough shingles of templates count.
2. A window's 64 one-row MinHash bands are looked up in a table band -> templates: what they hit is retrieved, all else
   is never looked at.  ``miss_bound`` gives the probability that a match isn't retrieved: at most (5/6)**64 < 1e-5.
3. Retrieved templates are verified at the window's starts: the share of their shingles is exact.

Both tables (shingles of templates, bands) are hashed into buckets and part of the plan, so a look-up costs the same however
many templates there are; their size is checked (``MAX_SHINGLES``).  All of it is row-local, native column functions: no
shuffle, no join, no group.

Edge cases: null counts as empty; texts and templates under five words have no shingles and don't match; repeated rows
are scanned each; extra columns pass through, one named like a result column is replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import boxed, table
from panelcast.llm.registry import query

SHINGLE = 5
BANDS = 64
LEAST = 0.8
#: Lengths within a class differ by this factor at most; a class's windows start every 1/STRIDES of its length.
SPREAD = 1.25
STRIDES = 4
#: Lengths share a class only if a match isn't retrieved with at most this probability.
MAX_MISS = 1e-5
#: All templates together may have so many shingles (the tables in the plan are of this size).
MAX_SHINGLES = 200_000

# Notices and texts of well-known licenses.
TEMPLATES = {
    "AGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MIT-licensed": "Licensed under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
}

MATCHES = "licenses"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_hashes_of(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def shingles_of(hashes: Column) -> Column:
    """Hashes of all runs of ``SHINGLE`` words, from the words' hashes."""
    n = F.size(hashes)
    run = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)])
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), run)).otherwise(F.array().cast("array<bigint>"))


def bands_of(shingles: Column) -> Column:
    """One key per band: the smallest of the shingles' hashes under the band's hash function."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, F.array_min(F.transform(shingles, lambda s: F.xxhash64(b, s)))))


def stride(longest: int) -> int:
    return max(1, longest // STRIDES)


def window_shingles(longest: int) -> int:
    """Shingles of a window: ``stride`` starts, and the 2 * ``longest`` words from the last of them on."""
    return 2 * longest - SHINGLE + stride(longest)


def needed(n: int, least: float = LEAST) -> int:
    """Shingles that a match of a template of ``n`` words has at least."""
    return max(1, math.ceil(least * (n - SHINGLE + 1) - 1e-9))


def miss_bound(n: int, longest: int, least: float = LEAST) -> float:
    """Largest probability that no band of a template of ``n`` words agrees with those of a window that holds a match."""
    shared = needed(n, least)
    return (1 - shared / (window_shingles(longest) + n - SHINGLE + 1 - shared)) ** BANDS


def length_classes(lengths, least: float = LEAST) -> dict[int, tuple[int, int]]:
    """Per template length the shortest and the longest length of its class; a class grows while its bands miss too little."""
    out, group = {}, []
    for n in [*sorted(set(lengths)), None]:
        if group and (n is None or n > group[0] * SPREAD or max(miss_bound(m, n, least) for m in [*group, n]) > MAX_MISS):
            out.update(dict.fromkeys(group, (group[0], group[-1])))
            group = []
        group.append(n)
    return out


def _template_rows(spark: SparkSession, templates: dict[str, str]) -> list:
    """Per template: words, shingles and bands, made by the same column functions as for the texts (a bounded table)."""
    df = spark.createDataFrame(sorted(templates.items()), "name string, text string").select("name", word_hashes_of(F.col("text")).alias("h"))
    df = df.select("name", F.size("h").alias("n"), shingles_of(F.col("h")).alias("s")).filter(F.size("s") > 0)
    rows = df.select("name", "n", F.array_distinct("s").alias("shingles"), bands_of(F.col("s")).alias("bands")).orderBy("name").collect()
    if sum(len(r.shingles) for r in rows) > MAX_SHINGLES:
        raise ValueError(f"templates have more than {MAX_SHINGLES} shingles")
    return rows


def _constant(value, schema: str) -> Column:
    """A nested constant, folded into one literal of the plan."""
    return F.from_json(F.lit(json.dumps(value)), schema)


class _Buckets:
    """Constant (key, value) pairs hashed into buckets: a look-up reads one of them."""

    def __init__(self, pairs):
        pairs = sorted(set(pairs))
        self.mask = (1 << max(4, len(pairs).bit_length())) - 1
        rows: list[list] = [[] for _ in range(self.mask + 1)]
        for k, t in pairs:
            rows[k & self.mask].append({"k": k, "t": t})
        self.table = _constant(rows, "array<array<struct<k:bigint,t:int>>>")

    def _bucket(self, key: Column) -> Column:
        return F.get(self.table, key.bitwiseAND(F.lit(self.mask).cast("long")).cast("int"))

    def has(self, key: Column) -> Column:
        return F.exists(self._bucket(key), lambda e: e["k"] == key)

    def values(self, key: Column) -> Column:
        return F.transform(F.filter(self._bucket(key), lambda e: e["k"] == key), lambda e: e["t"])


def _retrieved(rows: list, members: list[int], longest: int, fewest: int) -> Column:
    """(window, template) pairs of one class of templates: those that a band of the window hits."""
    step, width = stride(longest), window_shingles(longest)
    table_of = _Buckets((k, t) for t in members for k in rows[t].bands)
    numbers = F.array_distinct(F.transform("_hits", lambda p: (p / step).cast("int")))
    inside = lambda u: F.size(F.filter("_hits", lambda p: (p >= u * step) & (p < u * step + width)))
    windows = F.filter(numbers, lambda u: inside(u) >= fewest)
    bands = lambda u: bands_of(F.slice(F.col("_sh"), u * step + 1, F.lit(width)))
    met = lambda u: F.array_distinct(F.flatten(F.transform(bands(u), table_of.values)))
    pair = lambda u: F.transform(met(u), lambda t: F.struct((u * step).alias("start"), F.lit(step).alias("step"), t.alias("t")))
    return F.flatten(F.transform(windows, pair))


def license_scan(df: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """``df`` plus ``licenses array<struct<name, first_word, containment>>``: per template its best window (first of ties)."""
    rows = _template_rows(df.sparkSession, TEMPLATES if templates is None else templates)
    kind = "array<struct<name:string,first_word:bigint,containment:double>>"
    if not rows:
        return df.select(boxed(df, MATCHES), F.array().cast(kind).alias(MATCHES)).select("row.*", MATCHES)
    known = _Buckets((s, 0) for r in rows for s in r.shingles)
    facts = _constant([{"name": r.name, "size": 2 * r.n - SHINGLE + 1, "m": len(r.shingles), "s": list(r.shingles)} for r in rows],
                      "array<struct<name:string,size:int,m:int,s:array<bigint>>>")
    classes = length_classes((r.n for r in rows), least)

    x = df.select(boxed(df, MATCHES), word_hashes_of(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"))
    x = x.select("row", shingles_of(F.col("_h")).alias("_sh"))
    places = F.when(F.size("_sh") > 0, F.sequence(F.lit(0), F.size("_sh") - 1)).otherwise(F.array().cast("array<int>"))
    x = x.select("row", "_sh", F.filter(places, lambda p: known.has(F.get("_sh", p))).alias("_hits"))
    met = []
    for shortest, longest in sorted(set(classes.values())):
        members = [t for t, r in enumerate(rows) if classes[r.n] == (shortest, longest)]
        fewest = min(max(1, math.ceil(least * len(rows[t].shingles) - 1e-9)) for t in members)
        met.append(_retrieved(rows, members, longest, fewest))
    x = x.select("row", "_sh", "_hits", F.when(F.size("_hits") > 0, F.concat(*met)).alias("_met"))

    starts = lambda w: F.filter("_hits", lambda p: (p >= w["start"]) & (p < w["start"] + w["step"]))
    share = lambda t, p: F.size(F.array_intersect(F.get(facts, t)["s"], F.slice("_sh", p + 1, F.get(facts, t)["size"]))) / F.get(facts, t)["m"]
    score = lambda w: F.transform(starts(w), lambda p: F.struct(share(w["t"], p).alias("c"), (-p).alias("at"), w["t"].alias("t")))
    x = x.select("row", F.filter(F.flatten(F.transform("_met", score)), lambda w: w["c"] >= least).alias("_found"))
    best = lambda t: F.array_max(F.filter("_found", lambda w: w["t"] == t))
    named = lambda b: F.struct(F.get(facts, b["t"])["name"].alias("name"), (-b["at"]).cast("long").alias("first_word"), b["c"].alias("containment"))
    matches = F.transform(F.transform(F.array_sort(F.array_distinct(F.transform("_found", lambda w: w["t"]))), best), named)
    return x.select("row.*", F.coalesce(matches, F.array()).cast(kind).alias(MATCHES))


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.transform("licenses", lambda m: m["name"])
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(names, ",").alias("license_names"),
                        F.array_max(F.transform("licenses", lambda m: m["containment"])).alias("containment"))
