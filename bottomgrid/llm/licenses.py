"""Licence scanning with DataFrame functions only.

Units of a text (its lines, its paragraphs between blank lines, the sentences
of each paragraph and every two neighbouring ones, so that a notice between
other words is a unit too) are normalised to lower-case letter and digit words
and compared with licence templates by the Dice coefficient over distinct word
bigrams, 2 * common / (unit + template). Sizes bound it: with Dice >= t one size is at
most (2 - t) / t times the other, so a template is compared only with units in
its size range. Such a pair also shares at least t / (2 - t) of the template's
bigrams; ``key_words`` are chosen so that more than the remaining share of every
template's bigrams has one of them, and a unit without any is never cut into
bigrams.

Sibling licences differ in one word, so a template counts only if the unit also
has the markers of its licence (version, variant words) and none that speak for
another; a licence without a template is left out, not taken for its neighbour.

The templates are few and fixed, so they are one constant of the plan; a row is judged
from its own text without a shuffle. Null and empty texts, and units of no
word, match nothing; a unit of one word has that word as its only gram; units
that read the same count once. A notice that is more than two sentences inside
a longer paragraph is found sentence by sentence. Ties
in Dice go to the template listed first. Rows are independent: repeated rows
agree, an empty table stays empty, and input columns with the names of the
results are replaced.
"""

from __future__ import annotations

import json
import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_column, with_columns

# Short notices and the opening terms of public licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, "
             "or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
             "License, or (at your option) any later version."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("BSD", "This project is licensed under the terms of the BSD license."),
    ("ISC", "This project is licensed under the terms of the ISC license."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("MIT", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
            "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In "
            "no event shall the authors or copyright holders be liable for any claim, damages or other liability, "
            "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the "
            "software or the use or other dealings in the software."),
    ("ISC", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software "
            "including all implied warranties of merchantability and fitness. In no event shall the author be liable "
            "for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from "
            "loss of use, data or profits, whether in an action of contract, negligence or other tortious action, "
            "arising out of or in connection with the use or performance of this software."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission."),
    ("BSD", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
            "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for "
            "any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not "
            "limited to, procurement of substitute goods or services; loss of use, data, or profits; or business "
            "interruption) however caused and on any theory of liability, whether in contract, strict liability, or "
            "tort (including negligence or otherwise) arising in any way out of the use of this software, even if "
            "advised of the possibility of such damage."),
)
# the other Creative Commons licences, long and short
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_PORTS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
TEMPLATES += tuple(t for v, port in _PORTS.items() for c, words in _CC.items() for t in (
    (f"CC-{c}-{v}", f"This work is licensed under a Creative Commons {words} {v} {port} License."),
    (f"CC-{c}-{v}", f"Licensed under CC {c} {v}.")) if t not in TEMPLATES)

# headings of licence files, and tags in sources
TEMPLATES += (
    ("MIT", "MIT License"), ("MIT", "The MIT License"), ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Distributed under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD", "BSD 3-Clause License"), ("BSD", "BSD 2-Clause License"), ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD", "SPDX-License-Identifier: BSD-2-Clause"), ("ISC", "ISC License"), ("ISC", "SPDX-License-Identifier: ISC"),
    ("GPL-3.0", "GNU General Public License, Version 3"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "GNU General Public License, Version 2"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "GNU Lesser General Public License, Version 3"), ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("LGPL-2.1", "GNU Lesser General Public License, Version 2.1"), ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("AGPL-3.0", "GNU Affero General Public License, Version 3"), ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"), ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
)

# Licence: expressions that a unit must all have, and one that it must not
# have, over its bigrams joined by bars.
_SA, _NC, _ND = r"sharealike|share alike|\bsa\b", r"non ?commercial|\bnc\b", r"no ?deriv|\bnd\b"
_OTHER_GPL = r"\blesser\b|\blibrary general\b|\baffero\b"
MARKERS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "MIT": ((r"\bmit\b|hereby granted|permission notice|dealings in",), None),
    "Apache-2.0": ((r"\bapache\b", r"\b2 0\b|\b(version|v|apache|license) 2\b"), r"\bversion 1\b"),
    "Apache-1.1": ((r"\bapache\b", r"\b1 1\b"), None),
    "BSD": ((r"\bbsd\b|binary forms|its contributors|(and|or) contributors",), None),
    "ISC": ((r"\bisc\b|without fee|author disclaims",), None),
    "GPL-3.0": ((r"general public|\bgpl\b", r"\b(version|v|license|gpl) 3\b"), _OTHER_GPL),
    "GPL-2.0": ((r"general public|\bgpl\b", r"\b(version|v|license|gpl) 2\b"), _OTHER_GPL),
    "GPL": ((r"general public",), _OTHER_GPL),
    "AGPL-3.0": ((r"\baffero\b|\bagpl\b", r"\b(version|v|license|agpl) 3\b"), None),
    "AGPL": ((r"\baffero\b",), None),
    "LGPL-3.0": ((r"\blesser\b|\blgpl\b", r"\b(version|v|license|lgpl) 3\b"), None),
    "LGPL-2.1": ((r"\blesser\b|\blgpl\b", r"\b2 1\b"), None),
    "LGPL": ((r"\blesser\b|\blibrary general\b",), r"\baffero\b"),
    "MPL-2.0": ((r"\bmozilla\b|\bmpl\b", r"\b2 0\b|\b(version|v|license) 2\b"), None),
    "MPL-1.1": ((r"\bmozilla\b", r"\b1 1\b"), None),
    "CC0-1.0": ((r"\bwaived\b|\bcc0\b",), None),
    **{f"CC-{c}-{v}": ((r"\b" + v.replace(".", " ") + r"\b", *[x for n, x in (("SA", _SA), ("NC", _NC), ("ND", _ND)) if n in c]),
                       "|".join(x for n, x in (("SA", _SA), ("NC", _NC), ("ND", _ND)) if n not in c) or None)
       for v in _PORTS for c in _CC},
}
THRESHOLD = 0.8
SEPARATOR = "[^a-z0-9]+"
PARAGRAPH = r"\n[\x20\t\r]*\n"
SENTENCE_END = r"([.!?])[\x20\t\r\n]+"
CUT = "\x01"


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def template_grams(text: str) -> list[str]:
    return bigrams([w for w in re.split(SEPARATOR, text.lower()) if w])


def size_range(n: int, threshold: float) -> tuple[int, int]:
    """Sizes of a set whose Dice with a set of ``n`` can reach the threshold."""
    t = Fraction(str(threshold))
    return math.ceil(n * t / (2 - t)), math.floor(n * (2 - t) / t)


def key_words(sets: list[list[str]], threshold: float) -> list[str]:
    """Words of which each unit that reaches the threshold with a template has
    one: in every template more bigrams than a match may lack touch them. Long
    words come first, as they are rarer."""
    t = Fraction(str(threshold))
    chosen: set[str] = set()
    for grams in sets:
        spare = len(grams) - math.ceil(len(grams) * t / (2 - t))
        for w in sorted({w for g in grams for w in g.split(" ")}, key=lambda w: (-len(w), w)):
            if sum(not chosen.isdisjoint(g.split(" ")) for g in grams) > spare:
                break
            chosen.add(w)
    return sorted(chosen)


def _grams(unit: Column) -> Column:
    """Distinct word bigrams of a normalised unit."""
    w = F.array_remove(F.split(unit, " "), "")
    pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
                       F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(w) > 1, pairs).otherwise(w))


def scan_licenses(df: DataFrame, text_col: str = "text", templates=TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``df`` plus ``license`` and ``dice`` (the best match, null if none),
    ``n_matches`` (units that match) and ``licenses`` (the distinct names of
    all matches, sorted and comma-joined)."""
    sets = [(name, template_grams(text)) for name, text in templates]
    ranges = [size_range(len(g), threshold) for _, g in sets]
    low, high = min(a for a, _ in ranges), max(b for _, b in ranges)
    units, grams, best, t = (fresh(c) for c in ("units", "grams", "best", "text"))
    some = rf"(?<![a-z0-9])(?:{'|'.join(key_words([g for _, g in sets], threshold))})(?![a-z0-9])"

    text = F.coalesce(text_column(df, text_col), F.lit(""))
    text = F.when(F.lower(text).rlike(some), text).otherwise("")
    out = df.withColumn(t, text)
    # a unit of n distinct bigrams has at least n words of 1 or more letters;
    # too many characters alone do not exclude it, as words may repeat
    paragraphs = F.split(t, PARAGRAPH)
    cut = F.transform(paragraphs, lambda u: F.split(F.regexp_replace(u, SENTENCE_END, f"$1{CUT}"), CUT))
    two = lambda s: F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
                               lambda a, b: F.concat_ws(" ", a, b))
    parts = F.array_distinct(F.concat(F.split(t, "\n"), paragraphs, F.flatten(cut),
                                      F.flatten(F.transform(F.filter(cut, lambda s: F.size(s) > 1), two))))
    parts = F.filter(parts, lambda u: F.lower(u).rlike(some))
    norm = F.array_distinct(F.transform(parts, lambda u: F.trim(F.regexp_replace(F.lower(u), SEPARATOR, " "))))
    words = lambda u: F.size(F.split(u, " "))
    out = out.withColumn(units, norm)
    out = out.withColumn(units, F.filter(units, lambda u: (u != "") & u.rlike(some) & (words(u) >= (low if low == 1 else low + 1))))
    out = out.withColumn(grams, F.filter(F.transform(units, _grams), lambda g: F.size(g).between(low, high)))

    table = F.from_json(F.lit(json.dumps([
        {"k": -k, "lo": lo, "hi": hi, "grams": mine, "must": list(MARKERS.get(name, ((), None))[0]), "never": MARKERS.get(name, ((), None))[1]}
        for k, ((name, mine), (lo, hi)) in enumerate(zip(sets, ranges))])),
        "array<struct<k:int,lo:int,hi:int,grams:array<string>,must:array<string>,never:string>>")

    def score(g: Column) -> Column:
        """(dice, -template) of the best template for a unit; null if none."""
        dice = lambda m: F.size(F.array_intersect(g, m["grams"])) * 2.0 / (F.size(g) + F.size(m["grams"]))
        near = F.filter(F.filter(table, lambda m: F.size(g).between(m["lo"], m["hi"])), lambda m: dice(m) >= threshold)
        joined = F.array_join(g, " | ")
        ours = F.filter(near, lambda m: F.forall(m["must"], lambda x: F.rlike(joined, x))
                        & F.coalesce(~F.rlike(joined, m["never"]), F.lit(True)))
        return F.array_max(F.transform(ours, lambda m: F.struct(dice(m).alias("dice"), m["k"].alias("k"))))

    out = out.withColumn(best, F.filter(F.transform(grams, score), lambda s: s.isNotNull()))
    names = F.array(*[F.lit(n) for n, _ in sets])
    out = with_columns(out, {
        "license": F.when(F.size(best) > 0, F.get(names, -F.array_max(best)["k"])),
        "dice": F.when(F.size(best) > 0, F.array_max(best)["dice"]),
        "n_matches": F.size(best).cast("long"),
        "licenses": F.array_join(F.array_sort(F.array_distinct(F.transform(best, lambda s: F.get(names, -s["k"])))), ","),
    })
    return out.drop(units, grams, best, t)
