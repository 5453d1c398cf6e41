"""Licence scans: text units against licence templates by Dice's coefficient.

Every line of a document is a unit, and so is the whole text if it is short. A unit's and
a template's normalised words give sets of word bigrams; the coefficient is twice the
shared bigrams over the sum of both sizes. A coefficient of at least t needs sizes within
t / (2 - t) of each other, so a template whose size is out of bounds is not compared. A
unit without any template's bigram meets no template at all.

`places` has no such units: it finds every stretch of a text's words that is near a
template, across line ends and within lines. `scan` is bound to its SQL and keeps its units.

All of it is one projection over the scan: no shuffle, no join, no Python, and a row needs
memory for its own text only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import text_or_empty

#: Public licence notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)

#: Whole paragraphs and texts besides, for `places`.
MIT_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
PASSAGES = (
    *TEMPLATES,
    ("MIT", MIT_PERMISSION),
    ("MIT", f"{MIT_PERMISSION} {MIT_REST}"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
)


def normal_words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits; everything else separates them."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+", -1), "")


def bigrams(words: Column) -> Column:
    """The bigrams of a word list, repeats included; a single word is its own bigram."""
    pairs = F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) < 2, words).otherwise(F.filter(pairs, lambda p: p.isNotNull()))


def template_grams(text: str) -> list[str]:
    """`bigrams` of a template, on the driver."""
    words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    return list(dict.fromkeys(" ".join(words[i : i + 2]) for i in range(max(len(words) - 1, 1)))) if words else []


def _template_rows(templates: Sequence[tuple[str, str]]) -> Column:
    """The templates as a constant array."""
    grams = [(name, template_grams(text)) for name, text in templates]
    return F.array(*[F.struct(F.lit(n).alias("license"), F.lit(g).alias("grams"), F.lit(len(g)).alias("size")) for n, g in grams])


def scan(
    df: DataFrame,
    at_least: float = 0.8,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of df: the key, `n_lines`, `n_matched` units, and of the best
    unit the `license`, its coefficient `dice` and `line_no` (from 0; -1: the whole text).

    The whole text is a unit of its own if it has several lines and not over four times the
    characters of the longest template. Rows without a match have null license, dice and
    line_no; so have null, empty and wordless texts. Ties go to the whole text, the first
    line, then the smaller licence name. A null key stays null; rows that repeat each give
    a row; other columns are not read.
    """
    whole = 4 * max(len(t) for _, t in templates)
    known = _template_rows(templates)
    split = df.select(F.col(key), text_or_empty(text).alias("text")).withColumn("lines", F.split("text", "\n", -1))
    short = (F.size("lines") > 1) & (F.char_length("text") <= whole)
    # the first unit is the whole text, without words where it does not count
    bodies = F.concat(F.array(F.when(short, F.col("text")).otherwise("")), F.col("lines"))
    worded = F.transform(bodies, normal_words)
    units = split.withColumn(
        "units", F.transform(worded, lambda w, i: F.struct((i - 1).alias("at"), bigrams(w).alias("grams")))
    )
    every = F.lit(sorted({g for _, t in templates for g in template_grams(t)}))
    touched = F.filter("units", lambda u: F.arrays_overlap(u["grams"], every))
    distinct = lambda u: F.struct(u["at"].alias("at"), F.array_distinct(u["grams"]).alias("grams"))
    near = units.withColumn("near", F.transform(touched, distinct))
    found = near.withColumn("found", F.flatten(F.transform("near", lambda u: _matches(u, known, at_least))))
    best = F.array_min("found")
    return found.select(
        key,
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct(F.transform("found", lambda m: m["at"]))).cast("long").alias("n_matched"),
        best["license"].alias("license"),
        F.coalesce(-best["minus_dice"], F.lit(0.0)).alias("dice"),
        F.coalesce(best["at"], F.lit(-2)).cast("long").alias("line_no"),
    )


def _matches(unit: Column, known: Column, at_least: float) -> Column:
    """The templates that a unit matches, the best to sort first."""
    size = F.size(unit["grams"])

    def compared(t: Column) -> Column:
        inside = (size * (2 - at_least) >= t["size"] * at_least) & (t["size"] * (2 - at_least) >= size * at_least)
        shared = F.when(inside, F.size(F.array_intersect(unit["grams"], t["grams"]))).otherwise(0)
        return F.struct(
            (shared * -2.0 / (size + t["size"])).alias("minus_dice"), unit["at"].alias("at"), t["license"].alias("license")
        )

    return F.filter(F.transform(known, compared), lambda m: m["minus_dice"] <= -at_least)


def _place_templates(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    grams = [(name, template_grams(text)) for name, text in templates]
    short = [name for name, g in grams if not g or " " not in g[0]]
    if short:
        raise ValueError(f"templates of one word or none: {short}")
    return grams


def places(
    df: DataFrame,
    at_least: float = 0.8,
    templates: Sequence[tuple[str, str]] = PASSAGES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of df: the key, `n_places` where a template stands, and of the
    best place the `license`, its coefficient `dice`, and `first_line` and `last_line`.

    A place is any stretch of a text's words, across line ends and within lines, whatever
    the text's length. Its coefficient is 2s / (s + o + k): s different bigrams of the
    template, o other bigrams (each as often as it stands there), k bigrams of the template.
    Places that overlap count once, also those of several templates (it is the most places
    that stand apart). Ties go to the first
    place, then the smaller licence name, then the longer place. Rows without a place have
    a null license and lines -2.

    A stretch does not get worse when template bigrams next to it are taken in, so only
    those are tried that begin and end with a run of them. At least 0.8 leaves at most k / 2
    other bigrams, so a run meets at most k / 2 later ones.
    """
    grams = _place_templates(templates)
    known = _template_rows(templates)
    every = sorted({g for _, gs in grams for g in gs})
    split = df.select(F.col(key), F.split(text_or_empty(text), "\n", -1).alias("lines"))
    worded = split.withColumn("worded", F.transform("lines", normal_words)).withColumn("words", F.flatten("worded"))
    pairs = F.zip_with("words", F.slice("words", 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    marked = worded.withColumn("pairs", pairs).withColumn(
        "hits",
        F.filter(
            F.transform("pairs", lambda g, i: F.when(g.isin(every), F.struct(i.alias("at"), g.alias("gram")))),
            lambda h: h.isNotNull(),
        ),
    )

    def own(t: Column) -> Column:
        mine = F.filter("hits", lambda h: F.array_contains(t["grams"], h["gram"]))
        return F.struct(t["license"].alias("license"), t["size"].alias("size"), mine.alias("hits"))

    def enough(n: Column, others: Column, size: Column) -> Column:
        """Whether n different bigrams and some others reach the coefficient."""
        return n * 2.0 >= at_least * (n + others + size)

    def runs(t: Column) -> Column:
        """The first and last hit of each run of neighbouring hits, as indices."""
        at = lambda j: F.get(t["hits"], j)["at"]
        last = F.size(t["hits"]) - 1
        first = F.filter(F.sequence(F.lit(0), last), lambda j: (j == 0) | (at(j) - at(j - 1) > 1))
        final = F.filter(F.sequence(F.lit(0), last), lambda j: (j == last) | (at(j + 1) - at(j) > 1))
        return F.struct(
            t["license"].alias("license"), t["size"].alias("size"), t["hits"].alias("hits"),
            F.arrays_zip(first.alias("a"), final.alias("b")).alias("runs"),
        )

    def spans(t: Column) -> Column:
        at = lambda j: F.get(t["hits"], j)["at"]
        reach = F.floor(t["size"] * (2.0 / at_least - 2)).cast("int") + 1

        def ending(r: Column, e: Column) -> Column:
            n = e["b"] - r["a"] + 1
            start, end = at(r["a"]), at(e["b"])
            others = end - start + 1 - n
            shared = F.size(F.array_distinct(F.transform(F.slice(t["hits"], r["a"] + 1, n), lambda h: h["gram"])))
            good = enough(n, others, t["size"])
            dice = F.when(good, shared * 2.0 / (shared + others + t["size"])).otherwise(0.0)
            return F.struct(
                (-dice).alias("minus_dice"), start.alias("start"), t["license"].alias("license"), (-end).alias("minus_end")
            )

        ends = lambda r, i: F.transform(F.slice(t["runs"], i + 1, reach), lambda e: ending(r, e))
        return F.filter(F.flatten(F.transform(t["runs"], ends)), lambda m: m["minus_dice"] <= -at_least)

    zero = F.lit(0)
    # naming hits outside the lambda too keeps Spark from moving them into it, once a template
    near = F.when(F.size("hits") > 0, known).otherwise(F.slice(known, 1, 0))
    likely = F.filter(F.transform(near, own), lambda t: enough(F.size(t["hits"]), zero, t["size"]))
    found = (
        marked.withColumn("likely", likely)
        .withColumn("runs", F.transform("likely", runs))
        .withColumn("found", F.flatten(F.transform("runs", spans)))
    )
    stretch = lambda m: F.struct((-m["minus_end"]).alias("end"), m["start"].alias("start"))
    apart = F.aggregate(
        F.array_sort(F.transform("found", stretch)),
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")),
        lambda s, m: F.struct(
            (s["n"] + (m["start"] > s["end"]).cast("int")).alias("n"),
            F.when(m["start"] > s["end"], m["end"]).otherwise(s["end"]).alias("end"),
        ),
    )
    # the line of a word is the number of lines that end before it
    line_of = lambda word: F.aggregate(
        "worded",
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("line")),
        lambda s, w: F.struct(
            (s["words"] + F.size(w)).alias("words"), (s["line"] + (s["words"] + F.size(w) <= word).cast("int")).alias("line")
        ),
    )["line"]
    best = found.withColumn("best", F.array_min("found"))
    line = lambda word: F.coalesce(F.when(F.col("best").isNotNull(), line_of(word)), F.lit(-2)).cast("long")
    return best.select(
        key,
        apart["n"].cast("long").alias("n_places"),
        F.col("best.license").alias("license"),
        F.coalesce(-F.col("best.minus_dice"), F.lit(0.0)).alias("dice"),
        line(F.col("best.start")).alias("first_line"),
        line(1 - F.col("best.minus_end")).alias("last_line"),
    )


def oracle(documents: str, at_least: float = 0.8, templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    """The same in SQL."""
    quoted = ", ".join("('" + "', '".join(x.replace("'", "''") for x in row) + "')" for row in templates)
    whole = 4 * max(len(t) for _, t in templates)
    return f"""
with raw_units as (
  select doc_id, i - 1 as line_at, lines[i] as body from
    (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from {documents}) d, unnest(range(1, len(lines) + 1)) u(i)
  union all select doc_id, -1, text from {documents} where contains(text, chr(10)) and length(text) <= {whole}
), worded as (
  select *, list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda w: w <> '') as w from
    (select doc_id, line_at, body, null as license from raw_units union all select null, null, t, l from (values {quoted}) v(l, t))
), grams as (
  select *, case when len(w) = 0 then [] else list_distinct(list_transform(range(1, greatest(len(w) - 1, 1) + 1),
    lambda i: case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end)) end as g from worded
), every as (select list_distinct(flatten(list(g))) as e from grams where license is not null
), m as (
  select u.doc_id, u.line_at, t.license, 2.0::double * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) as dice
  from (select grams.* from grams, every where license is null and list_has_any(g, e)) u
  join (select * from grams where license is not null) t on len(u.g) * {2 - at_least} >= len(t.g) * {at_least} and len(t.g) * {2 - at_least} >= len(u.g) * {at_least}
), hits as (select * from m where dice >= {at_least}
), best as (select *, row_number() over (partition by doc_id order by dice desc, line_at, license) as r from hits
), n as (select doc_id, count(distinct line_at) as n_matched from hits group by doc_id)
select d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) as n_lines, coalesce(n_matched, 0) as n_matched,
  b.license, coalesce(b.dice, 0.0::double) as dice, cast(coalesce(b.line_at, -2) as bigint) as line_no
from {documents} d left join n on n.doc_id = d.doc_id left join best b on b.doc_id = d.doc_id and b.r = 1
"""
