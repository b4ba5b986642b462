"""Licence texts and notices in documents, by Dice coefficient. DataFrame functions only.

Each line, paragraph and whole text is normalised and compared with templates by
the bigrams of its words, repeats included: twice the bigrams in common over the
bigrams of both. A coefficient of t needs sizes within a factor of (2 - t) / t of
each other, so a size settles which templates are candidates, before any
bigram is made. Everything happens within the document's row: no shuffle.

Before that, words settle which texts and lines are looked at. Whatever resembles a
template has most of its bigrams, so of some words of it, chosen so that the
bigrams with them are too many to do without, one has to be there.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices by which texts state their licence, as their publishers word them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "apache-2.0-use": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License."
    ),
    "apache-2.0-terms": (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is '
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "mit-conditions": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "mit-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "isc-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "bsd-source-clause": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd-binary-clause": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-names-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "lgpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "agpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "cc-by-nc-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "cc0-1.0-line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "unlicense-line": "This is free and unencumbered software released into the public domain.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
    "spdx-gpl-2.0-only": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl-3.0-or-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}
#: Words that make another licence of one that is worded nearly alike: where one of them stands and the template
#: does not have it, the template does not apply.
APART = ("lesser", "affero", "sharealike", "noncommercial", "noderivatives", "noderivs")
#: Words that tell nothing, since any text has them.
COMMON = frozenset("a all and any are as at be by for from in is it may not of on or other that the this to under use with you".split())
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def template_bigrams(text: str) -> Counter:
    """A template in the same form; templates are plain ASCII."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The sizes at which a coefficient of ``threshold`` with ``size`` bigrams can be reached."""
    factor = (2 - threshold) / threshold
    return math.ceil(size / factor - 1e-9), math.floor(size * factor + 1e-9)


def telling_words(text: str, grams: Counter, threshold: float) -> list[str]:
    """Words of which one has to be in whatever resembles the template.

    A unit with a coefficient of ``threshold`` has at least so many of the template's bigrams as the smallest
    size that can reach it. Without any of these words, fewer would be left. Common words come last, and before
    them the longest first: they are the rarer ones.
    """
    size = sum(grams.values())
    spare = size - math.ceil(size / ((2 - threshold) / threshold) - 1e-9)
    words, found, covered = sorted({w for gram in grams for w in gram.split()}, key=lambda w: (w in COMMON, -len(w), w)), [], 0
    while covered <= spare:
        found.append(words.pop(0))
        covered = sum(n for gram, n in grams.items() if set(gram.split()) & set(found))
    return found


def _units(content: Column) -> Column:
    """Lines, paragraphs of several lines, and the whole text where it has several paragraphs.

    ``longest`` is the size of a paragraph's longest line, in bigrams.
    """

    def words_of(text: Column) -> Column:
        return F.trim(F.regexp_replace(text, r"\s+", " "))

    def unit(kind: str, text: Column, place: Column, longest: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("unit"), place.cast("int").alias("place"), words_of(text).alias("words"), longest.alias("longest")
        )

    lines = F.transform(F.split(content, "\n"), lambda line, i: unit("line", line, i, F.lit(0)))
    blocks = F.split(content, r"\n *\n[ \n]*")
    paragraphs = F.transform(blocks, lambda block, i: F.struct(i.alias("i"), F.trim(block).alias("block")))
    paragraphs = F.filter(paragraphs, lambda p: F.contains(F.trim(p["block"]), F.lit("\n")))
    size = lambda line: F.length(line) - F.length(F.replace(line, F.lit(" ")))
    longest = lambda block: F.array_max(F.transform(F.split(block, "\n"), lambda line: size(words_of(line))))
    paragraphs = F.transform(paragraphs, lambda p: unit("paragraph", p["block"], p["i"], longest(p["block"])))
    whole = F.when(F.size(blocks) > 1, F.array(unit("text", content, F.lit(0), F.lit(0))))
    return F.concat(lines, paragraphs, F.coalesce(whole, F.slice(lines, 1, 0)))


def licence_matches(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = 0.8,
    parts: bool = False,
    apart: Sequence[str] = APART,
) -> DataFrame:
    """A row per line, paragraph or whole text and the template it resembles most: doc_id, unit, place, template, dice.

    ``place`` counts from 0 among the document's lines or paragraphs. Of templates with
    equal coefficients the first by name counts. A template is no candidate for a unit that has one of the words
    ``apart`` which it lacks. Templates need two words; the few given are part of the plan. Texts that are null,
    empty or without two words in a row match nothing. Repeated rows give
    repeated results; other columns are not read.

    With ``parts``, also notices that share a line or paragraph with other words: a row of unit
    ``line part`` or ``paragraph part`` for one that resembles no template as a whole, and the template that
    some stretch of it, as long as the template, resembles most. In a paragraph these are templates
    longer than each of its lines; shorter ones are looked for in the lines.
    """
    known = [_template(name, body, threshold, apart) for name, body in sorted(templates.items())]
    known = [one for one in known if one["size"]]
    if not known:
        raise ValueError("licence_matches needs a template of two words or more")
    # One literal: an expression per template and bigram would be far larger than what it does.
    all_templates = F.from_json(F.lit(json.dumps(known)), F.lit(_TEMPLATE))
    any_telling = sorted({word for one in known for word in one["telling"]})

    # Words of letters and digits are in the text as they are in its normal form. Looked for at the starts of words only.
    some_telling = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(any_telling)})(?![\p{{L}}\p{{N}}])"
    lower = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), lower.alias("content"))
    rows = rows.where(F.col("content").rlike(some_telling))
    rows = rows.select("doc_id", F.inline(_units(F.regexp_replace("content", NOT_WORD, " "))))
    size = F.length("words") - F.length(F.replace(F.col("words"), F.lit(" ")))
    least, most = min(one["low"] for one in known), max(one["high"] for one in known)
    fits = (size >= least) & (size <= most)
    if parts:
        fits = (size >= least) & ((size <= most) | F.col("unit").isin("line", "paragraph"))
    rows = rows.withColumn("size", size).where(fits & F.col("words").rlike(some_telling))
    words = F.split("words", " ")
    bigrams = F.zip_with(
        F.slice(words, F.lit(1), F.col("size")),
        F.slice(words, F.lit(2), F.greatest(F.col("size"), F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    rows = rows.withColumns({"bigrams": bigrams, "apart": F.array_intersect(words, F.array(*map(F.lit, ("", *apart))))})

    def candidate(t: Column) -> Column:
        said = F.exists(t["telling"], lambda word: F.contains(F.col("words"), word))
        return said & (F.size(F.array_except("apart", t["apart"])) == 0)

    def best(judged: Column) -> Column:
        good = F.filter(judged, lambda f: f["dice"] >= threshold)
        return F.slice(F.array_sort(good), 1, 1)

    def named(t: Column, dice: Column) -> Column:
        return F.struct((-dice).alias("less"), t["name"].alias("template"), dice.alias("dice"))

    sized = F.filter(all_templates, lambda t: F.col("size").between(t["low"], t["high"]) & candidate(t))
    whole = F.transform(sized, lambda t: named(t, 2 * _shared(F.col("bigrams"), t) / (F.col("size") + t["size"])))
    rows = rows.withColumn("whole", best(whole))
    if not parts:
        return rows.select("doc_id", "unit", "place", F.inline("whole")).drop("less")
    longer = F.filter(
        all_templates,
        lambda t: (F.col("size") > t["size"]) & (t["size"] > F.col("longest")) & candidate(t) & _has_enough(t),
    )
    within = best(F.transform(longer, lambda t: named(t, _best_part(t))))
    shares = (F.col("unit") != "text") & (F.size("whole") == 0)
    rows = rows.withColumn("within", F.when(shares, within).otherwise(F.slice("whole", 1, 0)))
    unit = F.when(F.size("within") > 0, F.concat("unit", F.lit(" part"))).otherwise(F.col("unit"))
    return rows.select("doc_id", unit.alias("unit"), "place", F.inline(F.concat("whole", "within"))).drop("less")


_TEMPLATE = (
    "array<struct<name:string,size:int,low:int,high:int,enough:int,telling:array<string>,apart:array<string>,"
    "names:array<string>,grams:array<struct<gram:string,n:int>>>>"
)


def _template(name: str, body: str, threshold: float, apart: Sequence[str]) -> dict:
    """A template with its size, the sizes of units that can resemble it, and the words that decide whether to look.

    ``enough`` is how many different bigrams of it a stretch as long as it needs.
    """
    grams = template_bigrams(body)
    size = sum(grams.values())
    low, high = size_bounds(size, threshold)
    words = {word for gram in grams for word in gram.split()}
    return {
        "name": name,
        "size": size,
        "low": low,
        "high": high,
        "enough": math.ceil(round(threshold * size, 9)) - (size - len(grams)),
        "telling": telling_words(body, grams, threshold) if size else [],
        "apart": ["", *(word for word in apart if word in words)],
        "names": sorted(grams),
        "grams": [{"gram": gram, "n": n} for gram, n in sorted(grams.items())],
    }


def _has_enough(t: Column) -> Column:
    return F.size(F.array_intersect(F.col("bigrams"), t["names"])) >= t["enough"]


def _shared(bigrams: Column, t: Column) -> Column:
    def more(total: Column, one: Column) -> Column:
        return total + F.least(F.size(F.filter(bigrams, lambda b: b == one["gram"])), one["n"])

    return F.aggregate(t["grams"], F.lit(0), more)


def _best_part(t: Column) -> Column:
    """The dice of the best stretch of ``bigrams`` as long as the template, among those that begin or end with a bigram of it."""
    last = F.col("size") - t["size"] + 1
    places = F.transform("bigrams", lambda b, i: F.when(F.array_contains(t["names"], b), i + 1))
    places = F.filter(places, lambda i: i.isNotNull())
    starts = F.concat(places, F.transform(places, lambda i: i - t["size"] + 1))
    starts = F.array_distinct(F.transform(starts, lambda i: F.greatest(F.lit(1), F.least(i, last))))
    return F.array_max(F.transform(starts, lambda i: _shared(F.slice("bigrams", i, t["size"]), t) / t["size"]))
