"""License notices and texts found by the Dice coefficient over word bigrams (native).

A text is normalised (lower case, runs of other characters than letters and digits as one
space) and compared to the templates, wherever in it a licence stands: across line breaks
and inside lines.  For a template of L bigrams, the windows are the L bigrams (fewer at the
end of the text) from every place on where the text has a bigram of the template.  Dice is
twice the number of distinct bigrams that window and template share, over the sum of both
numbers of distinct bigrams.

Size bounds prune: Dice >= t needs at least t / (2 - t) times the template's distinct
bigrams in the window, so a window is cut out only where so many of them stand within L.
Texts without any word or word pair that a match must have are not cut into bigrams at all
(an exact test).

Defined cases: null, empty and one-word texts have no bigrams and match nothing; very long
texts are scanned whole; of a licence's templates the best counts, whichever it is on ties;
licences are listed by name; repeated rows are judged one by one; an empty table gives no
rows; a column named like the added one keeps its name, the added one gets an underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, quoted, step

# Notices, headers and texts by which works name their licence.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    ],
    "bsd-3-clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission.""",
    ],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU General Public License for more details.""",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ],
    "lgpl-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    ],
}


def bigrams(words: Column) -> Column:
    """All word bigrams of a word array, repeats included."""
    pairs = F.transform(words, lambda x, i: F.concat(x, F.lit(" "), F.get(words, i + 1)))
    return F.filter(pairs, lambda p: p.isNotNull())


def normalised(text: Column) -> Column:
    """Words of the normalised text."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda x: x != "")


def template_bigrams(text: str) -> tuple[int, list[str]]:
    """(number of word bigrams, distinct ones) of a template."""
    words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(pairs), sorted(set(pairs))


def fewest(grams: list[str], threshold: float) -> int:
    """Distinct bigrams of a template that a window must have to reach the threshold."""
    return math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)


def anchors(sets: list[list[str]], threshold: float) -> list[str]:
    """Patterns of which every match has one: a match lacks at most n - `fewest` of a template's
    n bigrams, so of one more than that it has at least one.  Long words that many of the
    bigrams have are taken first, then bigrams themselves."""
    words: list[str] = []
    pairs: list[str] = []
    for grams in sorted(sets, key=lambda g: (len(g), g)):
        least = len(grams) - fewest(grams, threshold) + 1
        open_ = [g for g in grams if g not in pairs and not any(w in g for w in words)]
        while len(grams) - len(open_) < least:
            long = {w for g in open_ for w in g.split() if len(w) >= 7}
            best = max(long, key=lambda w: (sum(w in g for g in open_), len(w), w), default=None)
            if best:
                words.append(best)
            else:
                pairs.append(max(open_, key=lambda g: (len(g), g)))
            open_ = [g for g in open_ if g not in pairs and not any(w in g for w in words)]
    return words + ["[^\\p{L}\\p{N}]+".join(g.split()) for g in pairs]


def scan(
    docs: DataFrame, text: str = "text", threshold: float = 0.9, templates: dict[str, list[str]] | None = None,
    into: str = "licenses"
) -> DataFrame:
    """Adds `into`: array of struct(name, dice), the best match of each licence that
    reaches the threshold anywhere in the text, ordered by name."""
    sets = {k: [template_bigrams(t) for t in v] for k, v in sorted((templates or TEMPLATES).items())}
    every = [grams for v in sets.values() for _, grams in v]
    (into,) = fresh(docs, into)
    cand, places = fresh(docs, into + "_bigrams", into + "_places")
    body = F.coalesce(quoted(text), F.lit(""))
    maybe = F.lower(body).rlike("|".join(anchors(every, threshold)))
    df = step(docs, docs.columns, cand, F.when(maybe, normalised(body)).otherwise(F.array().cast("array<string>")))
    df = step(df, docs.columns, cand, bigrams(quoted(cand)))
    known = sorted({g for grams in every for g in grams})
    at = F.filter(
        F.transform(quoted(cand), lambda g, i: F.when(g.isin(known), F.struct(g.alias("g"), i.alias("i")))),
        lambda x: x.isNotNull()
    )
    df = step(df, [*docs.columns, cand], places, at)

    def best(length: int, grams: list[str]) -> Column:
        """The highest Dice of the windows of one template."""
        here = F.transform(F.filter(quoted(places), lambda x: x["g"].isin(grams)), lambda x: x["i"])
        dense = F.filter(
            here, lambda i, k: F.coalesce(F.get(here, k + fewest(grams, threshold) - 1) - i < length, F.lit(False))
        )
        windows = F.transform(dense, lambda i: F.array_distinct(F.slice(quoted(cand), i + 1, F.lit(length))))
        literal = F.array(*map(F.lit, grams))
        return F.array_max(
            F.transform(
                windows, lambda w: F.lit(2.0) * F.size(F.array_intersect(w, literal)) / (F.size(w) + len(grams))
            )
        )

    found = [
        F.struct(F.lit(name).alias("name"), F.array_max(F.array(*(best(*t) for t in v))).alias("dice")) for name,
        v in sets.items()
    ]
    matches = F.filter(F.array(*found), lambda m: m["dice"] >= threshold)
    return step(
        df, docs.columns, into,
        F.when(F.size(quoted(places)) > 0, matches).otherwise(F.array().cast("array<struct<name:string,dice:double>>"))
    )
