"""License scan: runs of normalised words against license templates by the Dice coefficient of word bigrams.

A text is lower-cased, runs of anything but a-z and 0-9 become one space.  With n bigrams
in a run of words, t in a template and s shared (with repeats), Dice is 2 s / (n + t).  It
reaches the threshold d only if s >= t d / (2 - d) and n <= t (2 - d) / d: the first bound
leaves a text the templates of which it holds one of the t - s + 1 longest bigrams, the
second ends the runs.  (Whether a text holds one is a hashed overlap of two arrays.)  A run may start and end at any bigram it shares with the template,
so a notice is found in the middle of a line, over several lines or under a header.  Of
the runs from one word on the best counts (ties: first license by name, shorter run), and
a run is reported unless one that overlaps it is better (ties: the earlier one).  All of it
are column expressions inside one row, so nothing is shuffled; the work is in proportion
to the text's length.

Defined cases: null and empty texts have no hits; equal notices in a text are hits each;
rows are judged one by one, whatever their ids; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, table
from kiln.llm.quality import let

THRESHOLD = 0.8
ROUNDING = 1e-6         # Dice is rounded to six digits

#: Notices by which texts state a license, as published.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                "Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. "
                     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. "
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                "Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
            "IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at https://mozilla.org/MPL/2.0/."),
]


def bigrams(text: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bounds(t: int, threshold: float) -> tuple[int, int]:
    """Fewest shared and most bigrams of a run that reaches the threshold against t bigrams."""
    d = threshold - ROUNDING
    return math.ceil(t * d / (2 - d)), math.floor(t * (2 - d) / d)


def anchors(grams: list[str], fewest: int) -> list[str]:
    """The longest bigrams, so many that a run without any of them shares too few."""
    found, left = [], len(grams)
    for g in sorted(set(grams), key=lambda g: (-len(g), g)):
        if left < fewest:
            break
        found.append(g)
        left -= grams.count(g)
    return found


def prepared(templates, threshold: float) -> Column:
    """Templates as one literal: license, size, bounds, anchors, bigrams and how often each occurs."""
    rows = []
    for license_id, text in sorted(templates):
        grams = bigrams(text)
        if not grams:
            raise ValueError(f"a template of {license_id} has no two words")
        fewest, most = bounds(len(grams), threshold)
        once = sorted(set(grams))
        rows.append(F.struct(F.lit(license_id).alias("license"), F.lit(len(grams)).alias("t"), F.lit(fewest).alias("fewest"), F.lit(most).alias("most"),
                             F.array(*map(F.lit, anchors(grams, fewest))).alias("anchors"), F.array(*map(F.lit, once)).alias("grams"),
                             F.array(*[F.lit(grams.count(g)) for g in once]).alias("counts")))
    return F.array(*rows)


def before(values: Column, i: Column, n: Column) -> Column:
    """The n values before place i, or as many as there are."""
    return F.slice(values, F.greatest(i - n, F.lit(0)) + 1, F.least(i, n))


def runs(grams: Column, t: Column) -> Column:
    """For each shared bigram the best run that starts with it: (start, d: -Dice, license, end).

    A shared bigram counts in a run unless the run holds it as often as the template before;
    ``prev`` is the place the run must start after for it to count."""
    def place(shared, x, a):
        count = F.get(t["counts"], F.array_position(t["grams"], x["g"]).cast("int") - 1)
        same = F.filter(before(shared, a, t["most"]), lambda y: y["g"] == x["g"])
        return F.struct(x["i"].alias("i"), let(same, lambda s: F.coalesce(F.when(F.size(s) >= count, F.get(s, F.size(s) - count)["i"]), F.lit(-1))).alias("prev"))

    def best(x, counted):
        def run(y, r):
            dice = F.round(2 * (r + 1) / (y["i"] - x["i"] + 1 + t["t"]), 6)
            return F.struct(x["i"].alias("start"), (-dice).alias("d"), t["license"].alias("license"), (y["i"] + 1).alias("end"))
        return F.array_min(F.transform(counted, run))

    def ends(places, x, a):
        return F.filter(F.slice(places, a + 1, t["most"]), lambda y: (y["i"] < x["i"] + t["most"]) & (y["prev"] < x["i"]))

    shared = F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("i"), g.alias("g"))), lambda x: F.array_contains(t["grams"], x["g"]))
    return let(shared, lambda m: F.when(F.size(m) >= t["fewest"], let(
        F.transform(m, lambda x, a: place(m, x, a)), lambda places: F.transform(places, lambda x, a: best(x, ends(places, x, a))))))


def hits(plain: Column, templates: Column, some: Column, threshold: float, longest: int) -> Column:
    """The runs of a normalised text that are reported, in their order; ``some``: all templates' anchors."""
    def grams(words):
        return F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))

    def first_of_start(r, x, a):
        return (a == 0) | (F.get(r, a - 1)["start"] != x["start"])

    def unbeaten(r, x, a):
        around = F.slice(r, F.greatest(a - longest, F.lit(0)) + 1, F.lit(2 * longest + 1))
        return ~F.exists(around, lambda o: (o["start"] < x["end"]) & (x["start"] < o["end"]) & ((o["d"] < x["d"]) | ((o["d"] == x["d"]) & (o["start"] < x["start"]))))

    def among(g, fitting):
        every = F.flatten(F.transform(fitting, lambda t: F.filter(F.coalesce(runs(g, t), F.array()), lambda x: x["d"] <= -threshold)))
        one = let(F.array_sort(every), lambda r: F.filter(r, lambda x, a: first_of_start(r, x, a)))
        kept = let(one, lambda r: F.filter(r, lambda x, a: unbeaten(r, x, a)))
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), (x["end"] + 1).alias("end"), x["license"].alias("license"), (-x["d"]).alias("dice")))

    def fitted(g):
        fitting = F.filter(templates, lambda t: F.arrays_overlap(g, t["anchors"]))
        return F.when(F.arrays_overlap(g, some), let(fitting, lambda fit: F.when(F.size(fit) > 0, among(g, fit))))

    return let(F.split(plain, " "), lambda words: F.when(F.size(words) > 1, let(grams(words), fitted)))


def license_scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, hits (start and end in words, end excluded; license, dice) in
    the order of the text; licenses, each once by name."""
    templates = TEMPLATES if templates is None else templates
    known, sizes = prepared(templates, threshold), {text: bounds(len(bigrams(text)), threshold) for _, text in templates}
    some = F.array(*map(F.lit, sorted({g for text, (fewest, _) in sizes.items() for g in anchors(bigrams(text), fewest)})))
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "[^a-z0-9]+", " "))
    found = let(plain, lambda p: hits(p, known, some, threshold, max(most for _, most in sizes.values())))
    empty = F.array().cast("array<struct<start:int,end:int,license:string,dice:double>>")
    return (docs.select("doc_id", F.coalesce(found, empty).alias("hits"))
            .select("doc_id", "hits", F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"]))).alias("licenses")))


def oracle(templates, threshold: float) -> str:
    values = ", ".join("({}, '{}', {}, {})".format(i, name, bounds(len(bigrams(text)), threshold)[1], "[" + ", ".join(f"'{g}'" for g in bigrams(text)) + "]")
                       for i, (name, text) in enumerate(templates))
    return rf"""
WITH t AS (SELECT * FROM (VALUES {values}) v(id, license, most, g)),
tc AS (SELECT id, license, most, len(g) t, x, count(*) c FROM (SELECT id, license, most, g, unnest(g) x FROM t) GROUP BY ALL),
d AS (SELECT doc_id, row_number() OVER () k, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') w FROM documents),
b AS (SELECT k, unnest(generate_series(0, len(w) - 2)) pos, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) x FROM d WHERE len(w) > 1),
o AS (SELECT k, id, license, most, t, pos, c, row_number() OVER (PARTITION BY k, id, x ORDER BY pos) o, x FROM b JOIN tc USING (x)),
m AS (SELECT a.k, a.id, a.license, a.most, a.t, a.pos, coalesce(p.pos, -1) prev FROM o a LEFT JOIN o p ON p.k = a.k AND p.id = a.id AND p.x = a.x AND p.o = a.o - a.c),
r AS (SELECT a.k, a.license, a.id, a.pos s, p.pos + 1 e, a.t, row_number() OVER (PARTITION BY a.k, a.id, a.pos ORDER BY p.pos) n
  FROM m a JOIN m p ON p.k = a.k AND p.id = a.id AND p.pos >= a.pos AND p.pos < a.pos + a.most AND p.prev < a.pos),
s AS (SELECT k, s, license, e, round(2 * n / (e - s + t), 6) dice FROM r),
f AS (SELECT k, s, first(license ORDER BY dice DESC, license, e) license, first(e ORDER BY dice DESC, license, e) e, max(dice) dice FROM s WHERE dice >= {threshold} GROUP BY k, s),
h AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f o WHERE o.k = f.k AND o.s < f.e AND f.s < o.e AND (o.dice > f.dice OR (o.dice = f.dice AND o.s < f.s)))),
a AS (SELECT k, count(*) n, max(dice) dice, string_agg(DISTINCT license, ',' ORDER BY license) licenses FROM h GROUP BY k)
SELECT doc_id, coalesce(n, 0)::BIGINT n_hits, coalesce(licenses, '') licenses, coalesce(dice, 0)::DOUBLE best_dice FROM d LEFT JOIN a USING (k)
"""


@query("op3_license_scan", oracle(TEMPLATES, THRESHOLD))
def op3(spark, sf_dir):
    scanned = license_scan(table(spark, sf_dir, "documents"))
    top = F.coalesce(F.array_max(F.transform("hits", lambda h: h["dice"])), F.lit(0.0))
    return scanned.select("doc_id", F.size("hits").cast("long").alias("n_hits"), F.array_join("licenses", ",").alias("licenses"), top.alias("best_dice"))
