"""Scan documents for license texts by the Dice coefficient of word bigrams.

A document's units are its lines and its paragraphs (lines between blank ones).
Unit and template are normalised to lower-case words of letters and digits and
compared as bags of bigrams, ``2 * common / (size of one + size of the other)``.

With a coefficient of t or more, sizes differ by ``t / (2 - t)`` at most, so a unit
is compared with templates of such sizes only, and a unit that fits no size is dropped by its number of words. A
template's ``anchors`` are words that touch so many of its bigrams that a unit without any of
them cannot reach t; other units are dropped before a bigram is made.

Besides the units, every window of a text's words as long as a template is compared with it, so notices inside a
paragraph, wrapped ones and those behind comment marks are found: among windows that end before the same bigram, the one
that starts at a bigram of the template holds the most, so only these are looked at (and the one that ends with the text), and only
those with enough bigrams of the template. Texts shorter than a template are one window.

Only DataFrame functions are used; the templates are constants. Nothing is
shuffled: all of a document's units stand in its row.

Defined results: a null or empty text has no match; a text of one word has no
bigram and no match; of templates with equal coefficients the first in
``TEMPLATES`` wins, of equal windows the first in the text; repeated rows get equal results; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# License notices and grants as their licenses word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
        "Licensed under the BSD License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
        "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."],
}
THRESHOLD = (17, 20)  # as a fraction
WORD = r"[\p{L}\p{N}]+"


def normal_words(text: str) -> list[str]:
    """The same words in Python, for the constants."""
    return re.findall(r"[^\W_]+", text.lower())


def size_bounds(size: int, threshold: tuple[int, int] = THRESHOLD) -> tuple[int, int]:
    """Sizes of bags that can reach the threshold with a bag of ``size``."""
    part, whole = threshold
    return -(-part * size // (2 * whole - part)), (2 * whole - part) * size // part


def anchors(words: list[str], threshold: tuple[int, int] = THRESHOLD) -> set[str]:
    """Longest words of a template, as many as are needed that a unit without them shares too few bigrams."""
    chosen: set[str] = set()
    pairs = list(zip(words, words[1:], strict=False))
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(1 for pair in pairs if not chosen & set(pair)) < size_bounds(len(pairs), threshold)[0]:
            break
        chosen.add(word)
    return chosen


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for all its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _units(text: Column) -> Column:
    """Lines and paragraphs, each once."""
    return F.array_distinct(F.concat(F.split(text, r"\n"), F.split(text, r"\n(?:[ \t\r\f\x0B]*\n)+")))


def _template_constants(threshold: tuple[int, int]) -> Column:
    """Array of the templates: order, license, size, least and most (size bounds), bag of (bigram, times)."""
    rows = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            words = normal_words(text)
            bag = Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
            low, high = size_bounds(len(words) - 1, threshold)
            rows.append(F.struct(
                F.lit(-len(rows)).alias("order"), F.lit(name).alias("license"), F.lit(len(words) - 1).alias("size"),
                F.lit(low).alias("least"), F.lit(high).alias("most"),
                F.array(*[F.struct(F.lit(g).alias("bigram"), F.lit(n).alias("times")) for g, n in sorted(bag.items())]).alias("bag")))
    return F.array(*rows)


def _best(unit: Column, threshold: tuple[int, int]) -> Column:
    """Struct (dice, order, license, unit) of the best template of one unit, or null."""
    part, whole = threshold
    texts = [normal_words(t) for ts in TEMPLATES.values() for t in ts]
    sizes = [size_bounds(len(w) - 1, threshold) for w in texts]
    held = F.array(*map(F.lit, sorted(set().union(*(anchors(w, threshold) for w in texts)))))

    def compare(words: Column) -> Column:
        size = F.size(words) - 1
        pairs = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))

        def scores(found: Column) -> Column:
            def score(t: Column) -> Column:
                common = F.aggregate(t["bag"], F.lit(0), lambda n, b: n + F.least(
                    b["times"], F.size(F.filter(found, lambda p: p == b["bigram"]))))
                both = t["size"] + size
                return _bound(common, lambda c: F.when(c * 2 * whole >= both * part, F.struct(
                    (c * 2 / both).alias("dice"), t["order"].alias("order"), t["license"].alias("license"), unit.alias("unit"))))

            fitting = F.filter(_template_constants(threshold), lambda t: size.between(t["least"], t["most"]))
            return F.array_max(F.transform(fitting, score))

        return _bound(pairs, scores)

    fits = lambda w: F.size(w).between(min(s for s, _ in sizes) + 1, max(s for _, s in sizes) + 1)
    return _bound(F.regexp_extract_all(F.lower(unit), F.lit(WORD), F.lit(0)),
                  lambda w: F.when(fits(w) & F.arrays_overlap(w, held), compare(w)))


def _windows(text: Column, threshold: tuple[int, int]) -> Column:
    """Per template the struct (dice, order, license, unit) of its best window in the text, or null; null without anchors."""
    part, whole = threshold
    own = [normal_words(t) for ts in TEMPLATES.values() for t in ts]
    held = F.array(*map(F.lit, sorted(set().union(*(anchors(w, threshold) for w in own)))))
    bigrams = sorted({f"{a} {b}" for w in own for a, b in zip(w, w[1:], strict=False)})

    def search(words: Column) -> Column:
        n = F.size(words) - 1  # bigrams of the text
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            i.alias("at"), F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)).alias("bigram")))
        return _bound(F.filter(at, lambda h: h["bigram"].isin(bigrams)),
                      lambda hits: F.transform(_template_constants(threshold), lambda t: of_template(words, n, hits, t)))

    def of_template(words: Column, n: Column, hits: Column, t: Column) -> Column:
        length = F.least(t["size"], n)
        need = F.ceil((length + t["size"]) * part / F.lit(2.0 * whole) - 1e-9).cast("int")
        mine = F.filter(hits, lambda h: F.array_contains(t["bag"]["bigram"], h["bigram"]))
        return F.when(F.size(hits) >= need, _bound(mine, lambda m: best_window(words, n, m, t, length, need)))

    def best_window(words: Column, n: Column, mine: Column, t: Column, length: Column, need: Column) -> Column:
        last = n - length
        begun = F.transform(mine, lambda h, j: F.when(
            (h["at"] <= last) & (F.get(mine, j + need - 1)["at"] < h["at"] + length), score(F.slice(mine, j + 1, length), h["at"], t, length)))
        ending = score(F.filter(mine, lambda h: h["at"] >= last), last, t, length)
        found = F.array_max(F.concat(begun, F.array(ending)))
        both = t["size"] + length
        return F.when(F.size(mine) >= need, _bound(found, lambda f: F.when(f["common"] * 2 * whole >= both * part, F.struct(
            (f["common"] * 2 / both).alias("dice"), t["order"].alias("order"), t["license"].alias("license"),
            F.array_join(F.slice(words, 1 - f["back"], length + 1), " ").alias("unit")))))

    def score(near: Column, start: Column, t: Column, length: Column) -> Column:
        """Bigrams in common with the window at ``start``, and the start, smaller ones first among equals."""
        inside = F.transform(F.filter(near, lambda h: h["at"] < start + length), lambda h: h["bigram"])

        def common(found: Column) -> Column:
            again = F.filter(t["bag"], lambda b: b["times"] > 1)
            more = F.aggregate(again, F.lit(0), lambda c, b: c + F.greatest(F.lit(0), F.least(
                b["times"], F.size(F.filter(found, lambda g: g == b["bigram"]))) - 1))
            return F.struct((F.size(F.array_intersect(t["bag"]["bigram"], found)) + more).alias("common"), (-start).alias("back"))

        return _bound(inside, common)

    return _bound(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)),
                  lambda w: F.when((F.size(w) > 1) & F.arrays_overlap(w, held), search(w)))


def scan(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row: doc_id; matches, an array of (dice, order, license, unit), one for each unit that fits a template; and passages,
    the same with the words of the best window, one for each template that has one; the best first.
    """
    found = F.filter(F.transform(_units(F.coalesce("text", F.lit(""))), lambda u: _best(u, threshold)), lambda m: m.isNotNull())
    passages = F.filter(_windows(F.coalesce("text", F.lit("")), threshold), lambda m: m.isNotNull())
    return docs.select("doc_id", F.sort_array(found, asc=False).alias("matches"),
                       F.sort_array(F.coalesce(passages, F.filter(found, lambda m: F.lit(False))), asc=False).alias("passages"))


def best(scanned: DataFrame) -> DataFrame:
    """Rows of :func:`scan` with ``best``, the (dice, order, license) of the best unit or passage, or null."""
    short = lambda m: F.struct(m["dice"], m["order"], m["license"])
    return scanned.withColumn("best", F.array_max(F.concat(F.transform("matches", short), F.transform("passages", short))))
