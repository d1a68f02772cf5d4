"""Licence scan: windows of words compared with licence templates by Dice over word bigrams.

A text is normalised (letters A-Z folded, everything but letters, digits and
line ends becomes a blank).  The templates are short notices, SPDX tags, file
headers and licence bodies.  A template of ``a`` bigrams is compared with

* every whole line: 2 * shared / (a + b) over the sets of bigrams, and
* windows of words, across line ends, that start and end with a bigram of the
  template, up to half as long again as the template: b counts the shared
  bigrams and every other bigram of the window, and is ``a`` at least, since
  cutting words off must not raise the score.

From the threshold on a line or window is a hit; of overlapping hits the best
stays (then the one with more shared bigrams, then the first).  A hit is placed
at its first word's line.

A hit must also have the bigrams that tell its licence from its neighbours:
versions, and the words in which two licences' notices differ.  Without one of
them nothing is reported, so a notice with a restriction or version that no
template has never passes for one without.

Either score needs a certain number of the template's bigrams in the text.  A
text without any of a few words that these cannot do without is not looked at
further; one without enough bigrams is dropped after one set intersection, so
only texts close to a licence are searched.  Pure expressions, no shuffle; the
templates are a fixed list in the plan.

Defined results: a null text has no lines; lines of fewer than two words have
no bigrams and match nothing; of equal hits the first template name wins;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import let, running_sums

THRESHOLD = 0.8

# SPDX id or expression -> short notices in common use; families follow below
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "Apache-2.0 OR MIT": [
        "Licensed under either of Apache License, Version 2.0 or MIT license at your option",
        "Licensed under either of the Apache License, Version 2.0 or the MIT license",
        "Licensed under the MIT license or the Apache License, Version 2.0",
    ],
    "BSD-2-Clause": ["Released under the 2-Clause BSD License", "Licensed under the BSD 2-Clause License"],
    "BSD-3-Clause": ["Released under the 3-Clause BSD License", "Licensed under the BSD 3-Clause License"],
    "CC0-1.0": ["Released under CC0 1.0 Universal", "This work is dedicated to the public domain under CC0 1.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"],
}
# Words of the Creative Commons elements, the regions in the full
# names of the versions, and the versions of the GNU licences.
CC_WORDS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_KINDS = ["BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA"]
CC_VERSIONS = {"3.0": "Unported", "4.0": "International"}
GNU = {"AGPL": ("Affero General", ["3"]), "GPL": ("General", ["2", "3"]), "LGPL": ("Lesser General", ["2.1", "3"])}

for _kind in CC_KINDS:
    for _version, _region in CC_VERSIONS.items():
        _name = "-".join(CC_WORDS[w] for w in _kind.split("-"))
        TEMPLATES[f"CC-{_kind}-{_version}"] = [
            f"Licensed under CC {_kind} {_version}",
            f"This work is licensed under a Creative Commons {_name} {_version} {_region} License",
        ]
for _short, (_name, _versions) in GNU.items():
    for _version in _versions:
        TEMPLATES[f"{_short}-{_version if '.' in _version else _version + '.0'}"] = [
            f"This work is licensed under the GNU {_name} Public License, version {_version}"
        ]

# SPDX id -> whole licence bodies and file headers, without marks
BODIES = {
    "AGPL-3.0": [
        "This program is free software you can redistribute it and or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation either version 3 of the License or at your "
        "option any later version This program is distributed in the hope that it will be useful but WITHOUT ANY "
        "WARRANTY without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE See the GNU "
        "Affero General Public License for more details You should have received a copy of the GNU Affero General "
        "Public License along with this program",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License Version 2 0 the License you may not use this file except in compliance with "
        "the License You may obtain a copy of the License at http www apache org licenses LICENSE 2 0 Unless required "
        "by applicable law or agreed to in writing software distributed under the License is distributed on an AS IS "
        "BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND either express or implied See the License for the specific "
        "language governing permissions and limitations under the License",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 Redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer 2 Redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND "
        "ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES INCLUDING BUT NOT LIMITED "
        "TO PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS INTERRUPTION HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING NEGLIGENCE OR "
        "OTHERWISE ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 Redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer 2 Redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution 3 Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior written "
        "permission THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES INCLUDING BUT NOT LIMITED TO PROCUREMENT "
        "OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS INTERRUPTION HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING NEGLIGENCE OR OTHERWISE ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    ],
    "GPL-2.0": [
        "This program is free software you can redistribute it and or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation either version 2 of the License or at your option "
        "any later version This program is distributed in the hope that it will be useful but WITHOUT ANY WARRANTY "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE See the GNU General "
        "Public License for more details You should have received a copy of the GNU General Public License along with "
        "this program",
    ],
    "GPL-3.0": [
        "This program is free software you can redistribute it and or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation either version 3 of the License or at your option "
        "any later version This program is distributed in the hope that it will be useful but WITHOUT ANY WARRANTY "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE See the GNU General "
        "Public License for more details You should have received a copy of the GNU General Public License along with "
        "this program",
    ],
    "ISC": [
        "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies THE SOFTWARE "
        "IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL DIRECT "
        "INDIRECT OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE DATA OR PROFITS WHETHER "
        "IN AN ACTION OF CONTRACT NEGLIGENCE OR OTHER TORTIOUS ACTION ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE",
    ],
    "LGPL-2.1": [
        "This library is free software you can redistribute it and or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation either version 2 1 of the License or at "
        "your option any later version This library is distributed in the hope that it will be useful but WITHOUT ANY "
        "WARRANTY without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE See the GNU "
        "Lesser General Public License for more details You should have received a copy of the GNU Lesser General "
        "Public License along with this library",
    ],
    "LGPL-3.0": [
        "This program is free software you can redistribute it and or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation either version 3 of the License or at your "
        "option any later version This program is distributed in the hope that it will be useful but WITHOUT ANY "
        "WARRANTY without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE See the GNU "
        "Lesser General Public License for more details You should have received a copy of the GNU Lesser General "
        "Public License along with this program",
    ],
    "MIT": [
        "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the Software to deal in the Software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the Software and to permit "
        "persons to whom the Software is furnished to do so subject to the following conditions The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software THE "
        "SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION OF "
        "CONTRACT TORT OR OTHERWISE ARISING FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0 If a copy of the MPL was not "
        "distributed with this file You can obtain one at http mozilla org MPL 2 0",
    ],
}


def all_templates() -> dict[str, list[str]]:
    names = sorted(TEMPLATES | BODIES)
    return {n: [*TEMPLATES.get(n, []), f"SPDX-License-Identifier: {n}", *BODIES.get(n, [])] for n in names}


NOTICE = 20  # bigrams of a template up to which its numbers must all be there
CLOSE = 6  # templates of two licences that differ in at most so many bigrams must differ in all


def template_bigrams(templates: dict[str, list[str]]) -> list[dict]:
    """Name, bigrams, number of word pairs, and the bigrams that a hit must have (``must``).

    A template must not stand for its neighbours: what tells it from a template of
    another licence that is alike but for a few words, and the numbers of a short
    notice, have to be there in full, or nothing is reported.
    """
    out = []
    for name in sorted(templates):
        for text in templates[name]:
            words = re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()
            out.append({"name": name, "grams": sorted({f"{a} {b}" for a, b in zip(words, words[1:])}), "raw": len(words) - 1})
    for t in out:
        mine, must = set(t["grams"]), set()
        if len(mine) <= NOTICE:
            must |= {g for g in mine if any(w.isdigit() for w in g.split())}
        for u in out:
            own, theirs = mine - set(u["grams"]), set(u["grams"]) - mine
            if u["name"] != t["name"] and len(own) <= CLOSE and len(theirs) <= CLOSE and 2 * len(own) < len(mine):
                must |= own
        t["must"] = sorted(must)
    return out


#: Words too frequent in any text to tell that a licence may follow
FREQUENT = ["above", "after", "other", "their", "there", "these", "under", "which", "without"]


def anchors(known: list[dict], least: list[int]) -> tuple[list[str], list[str]]:
    """(words, bigrams): a text without any of them has no hit.

    Greedy over longer words: the one that spares most of the bigrams still in the
    way, until those without a chosen word are fewer than ``least`` for every
    template.  A template that longer words cannot cover gives one of the bigrams
    that its hits must have.
    """
    words: list[str] = []
    grams: list[str] = []

    def free(t):
        return [g for g in t["grams"] if not set(g.split()) & set(words)]

    for t, n in zip(known, least):
        usable = [w for g in t["grams"] for w in g.split() if len(w) > 4 and w not in FREQUENT]
        if sum(not set(g.split()) & set(usable) for g in t["grams"]) >= n:
            if not t["must"]:
                raise ValueError(f"a template of {t['name']} has no word to look for")
            grams.append(max(t["must"], key=lambda g: (len(g), g)))
    covered = [(t, n) for t, n in zip(known, least) if not set(grams) & set(t["must"])]
    while left := [free(t) for t, n in covered if len(free(t)) >= n]:
        gain = Counter(w for gs in left for g in gs for w in set(g.split()) if len(w) > 4 and w not in FREQUENT)
        words.append(min(gain, key=lambda w: (-gain[w] * len(w), w)))
    return words, sorted(set(grams))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Set sizes b for which 2 * min(a, b) / (a + b) can reach the threshold."""
    low = next(b for b in range(1, size + 1) if 2 * b >= threshold * (size + b))
    high = size
    while 2 * size >= threshold * (size + high + 1):
        high += 1
    return low, high


def bigrams(words: Column) -> Column:
    """Word pairs of an array of words, in order."""
    return let(
        words,
        lambda ws: F.when(
            F.size(ws) > 1,
            F.zip_with(
                F.slice(ws, F.lit(1), F.size(ws) - 1), F.slice(ws, F.lit(2), F.size(ws) - 1), lambda a, b: F.concat_ws(" ", a, b)
            ),
        ).otherwise(F.expr("cast(array() as array<string>)")),
    )


def words_of(text: Column, ends: str) -> Column:
    return F.filter(F.split(text, ends), lambda w: w != "")


def candidate(t: Column, score: Column, shared: Column, start: Column, end: Column) -> Column:
    """Sorts best first; start and end are word positions, end exclusive."""
    return F.struct(
        (-score).alias("cost"), (-shared).alias("less"), start.alias("start"), t["name"].alias("licence"), end.alias("end")
    )


def windows(t: Column, grams: Column, threshold: float) -> Column:
    """The best window at every bigram of the text that can start one of template ``t``."""
    numbered = F.transform(grams, lambda g, i: F.struct(i.alias("at"), F.array_position(t["grams"], g).alias("id")))

    def at_start(hits, p):
        reach = F.filter(F.slice(hits, p + 1, t["span"]), lambda h: h["at"] < F.get(hits, p)["at"] + t["span"])

        def ends(near):
            ids = F.transform(near, lambda h: h["id"])

            def to_end(q):
                first, last = F.get(near, F.lit(0))["at"], F.get(near, q)["at"]

                def judged(have):
                    shared = F.size(have)
                    score = F.lit(2.0) * shared / (t["a"] + F.greatest(t["a"], shared + (last - first - q)))
                    whole = F.size(F.array_intersect(t["must_ids"], have)) == F.size(t["must_ids"])
                    return F.when(whole, candidate(t, score, shared, first, last + 2))

                return let(F.array_distinct(F.slice(ids, F.lit(1), q + 1)), judged)

            return F.when(
                F.size(F.array_distinct(ids)) >= t["most"],
                F.array_min(F.transform(F.sequence(t["most"] - 1, F.size(near) - 1), to_end)),
            )

        return F.when(F.size(reach) >= t["most"], let(reach, ends))

    def search(hits):
        starts = F.sequence(F.lit(0), F.size(hits) - 1)
        return F.filter(F.transform(starts, lambda p: at_start(hits, p)), lambda c: c["cost"] <= -threshold)

    return F.when(F.size(hits_of(numbered)) > 0, let(hits_of(numbered), search)).otherwise(F.expr(NO_CANDIDATES))


def hits_of(numbered: Column) -> Column:
    return F.filter(numbered, lambda h: h["id"] > 0)


NO_CANDIDATES = "cast(array() as array<struct<cost:double,less:int,start:int,licence:string,end:int>>)"
NO_HITS = "cast(array() as array<struct<line:int,licence:string,dice:double>>)"


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: id, hits array<struct<line, licence, dice>> (lines from 0)."""
    known = template_bigrams(templates or all_templates())
    bounds = [size_bounds(len(t["grams"]), threshold) for t in known]
    rows = []
    for t, (low, high) in zip(known, bounds):
        a = len(t["grams"])
        shared = [s for s in range(1, a + 1) if 2 * s >= threshold * (a + max(s, low)) - 1e-9]
        most = next(s for s in range(1, a + 1) if 2 * s >= threshold * 2 * a - 1e-9)
        ids = [t["grams"].index(g) + 1 for g in t["must"]]
        rows.append(
            t | {"a": a, "low": low, "high": high, "least": shared[0], "most": most, "span": t["raw"] * 3 // 2, "must_ids": ids}
        )
    shapes = F.from_json(
        F.lit(json.dumps(rows)),
        "array<struct<name:string,grams:array<string>,a:int,low:int,high:int,least:int,most:int,span:int,must:array<string>,must_ids:array<int>>>",
    )
    every = F.from_json(F.lit(json.dumps(sorted({g for t in known for g in t["grams"]}))), "array<string>")
    fewest = min(r["least"] for r in rows)

    def of_lines(live, lines):
        def one(l):
            def scored(grams):
                fits = F.filter(
                    live,
                    lambda t: (F.size(grams) >= t["low"])
                    & (F.size(grams) <= t["high"])
                    & (F.size(F.array_intersect(t["must"], grams)) == F.size(t["must"])),
                )
                return F.transform(
                    fits,
                    lambda t: let(
                        F.size(F.array_intersect(grams, t["grams"])),
                        lambda n: candidate(t, F.lit(2.0) * n / (F.size(grams) + t["a"]), n, l["start"], l["start"] + F.size(l["words"])),
                    ),
                )

            return let(F.array_distinct(bigrams(l["words"])), scored)

        return F.filter(F.flatten(F.transform(lines, one)), lambda c: c["cost"] <= -threshold)

    def chosen(candidates, lines):
        def keep(kept, c):
            clash = F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"]))
            return F.when(clash, kept).otherwise(F.concat(kept, F.array(c)))

        best = F.aggregate(F.array_sort(candidates), F.expr(NO_CANDIDATES), keep)
        placed = F.transform(
            best,
            lambda c: F.struct(
                (F.size(F.filter(lines, lambda l: l["start"] <= c["start"])) - 1).alias("line"),
                c["start"].alias("start"),
                c["licence"].alias("licence"),
                (-c["cost"]).alias("dice"),
            ),
        )
        return F.transform(F.array_sort(placed), lambda h: F.struct(h["line"], h["licence"], h["dice"]))

    def search(live, text, grams):
        words = F.transform(F.split(text, "\n"), lambda l: words_of(l, " "))

        def by_line(ws):
            starts = running_sums(F.transform(ws, lambda w: F.size(w)))
            lines = F.zip_with(ws, starts, lambda w, s: F.struct(w.alias("words"), s.alias("start")))
            return let(
                lines,
                lambda ls: chosen(
                    F.concat(of_lines(live, ls), F.flatten(F.transform(live, lambda t: windows(t, grams, threshold)))), ls
                ),
            )

        return let(words, by_line)

    def found(text):
        def in_grams(grams):
            def in_known(common):
                live = F.filter(shapes, lambda t: F.size(F.array_intersect(t["grams"], common)) >= t["least"])
                return F.when(
                    F.size(common) >= fewest,
                    let(live, lambda ts: F.when(F.size(ts) > 0, search(ts, text, grams)).otherwise(F.expr(NO_HITS))),
                ).otherwise(F.expr(NO_HITS))

            return let(F.array_intersect(grams, every), in_known)

        return let(bigrams(words_of(text, "[ \n]+")), in_grams)

    raw = F.coalesce(F.col(text_col), F.lit(""))
    text = F.lower(F.regexp_replace(raw, r"[^A-Za-z0-9\n]+", " "))
    folded = F.lower(raw)
    words, grams = anchors(known, [r["least"] for r in rows])
    maybe = F.lit(False)
    for word in words:
        maybe = maybe | folded.contains(word)
    if grams:
        apart = "|".join(g.replace(" ", "[^a-z0-9]+") for g in grams)
        maybe = maybe | folded.rlike(f"(?<![a-z0-9])(?:{apart})(?![a-z0-9])")
    hits = F.when(maybe, let(text, found)).otherwise(F.expr(NO_HITS))
    return docs.select(F.col(id_col).alias("_id"), hits.alias("hits")).withColumnRenamed("_id", id_col)
