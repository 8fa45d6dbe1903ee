"""Licence notices and texts by the Dice coefficient over word bigrams.

Built of DataFrame functions only. A text is normalised to lower-case words,
whatever its lines and signs. A Dice coefficient of t needs sizes within
(2 - t) / t of each other, which bounds what two sets must share, and so every
match has one of a template's rarest bigrams, its heads. Where a head occurs, the
window that has it in the head's own place, as many bigrams long as the
template, is compared with the template, if its size is within the bounds.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pii import let

# Notices by which public licences are granted or named, and whole texts of short licences.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "agpl-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "bsd-3-clause": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}


# Words so common that bigrams of them alone tell little.
COMMON = frozenset("a all and any as at be by for from in is it may not of on or that the this to under use with without you".split())


def words_of(text: str) -> list[str]:
    return re.sub(r"[^\w]+|_", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """Word bigrams of a template, in order, repeats included."""
    words = words_of(text)
    return [" ".join(p) for p in zip(words, words[1:])]


def template_table(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[str]]]:
    return [(name, bigrams(t)) for name, texts in templates.items() for t in texts]


def size_bounds(n: int, least: float) -> tuple[int, int]:
    """Sizes that a set can have whose Dice coefficient with one of n elements is ``least`` or more."""
    return math.ceil(n * least / (2 - least) - 1e-9), math.floor(n * (2 - least) / least + 1e-9)


def prefix(grams: list[str], least: float, seen: dict[str, int]) -> list[str]:
    """The rarest bigrams of a template one of which every match has. Bigrams of common words count as frequent."""
    distinct = list(dict.fromkeys(grams))
    low = size_bounds(len(distinct), least)[0]
    common = math.ceil(least * (len(distinct) + low) / 2 - 1e-9)
    return sorted(distinct, key=lambda g: (sum(w in COMMON for w in g.split()), seen[g], g))[: len(distinct) - common + 1]


def heads_of(table: list[tuple[str, list[str]]], least: float) -> list[tuple[str, int, int]]:
    """(bigram, template, place) of all templates' heads, a row for each place."""
    seen: dict[str, int] = {}
    for _, grams in table:
        for g in set(grams):
            seen[g] = seen.get(g, 0) + 1
    return [(g, t, at) for t, (_, grams) in enumerate(table) for chosen in [set(prefix(grams, least, seen))] for at, g in enumerate(grams) if g in chosen]


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def scan(docs: DataFrame, least: float = 0.8, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(doc_id, found): every document with its matched windows, in order: (start, size, license, dice).

    start is the window's first word and size its number of bigrams. Of windows
    that overlap, one stands only if none of the others is better: a higher
    coefficient, then a longer template, then the name, then the place. Null
    text counts as empty, texts of one word have no bigram. Repeated rows stay,
    an empty table gives no row; other columns are ignored. The whole search is
    within the row: nothing is shuffled.
    """
    table = template_table(templates or TEMPLATES)
    places: dict[str, list[tuple[int, int]]] = {}
    for g, t, at in heads_of(table, least):
        places.setdefault(g, []).append((t, at))
    fixed = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)  # noqa: E731  one literal for a whole table
    heads = fixed(list(places), "array<string>")
    rare = fixed(sorted({min(g.split(), key=lambda w: (w in COMMON, -len(w), w)) for g in places}), "array<string>")
    by_head = fixed({g: [{"t": t, "at": at} for t, at in where] for g, where in places.items()}, "map<string,array<struct<t:int,at:int>>>")
    grams = fixed([list(dict.fromkeys(g)) for _, g in table], "array<array<string>>")
    lengths, names = fixed([len(g) for _, g in table], "array<int>"), fixed([n for n, _ in table], "array<string>")
    bounds = fixed([dict(zip(("low", "high"), size_bounds(len(set(g)), least))) for _, g in table], "array<struct<low:int,high:int>>")
    row = "array<struct<start:int,size:int,license:string,dice:double>>"

    def compared(pairs: Column, at: Column) -> Column:
        """A window (template t, start) with its coefficient, 0 if its size is out of bounds."""
        size, first = F.element_at(lengths, at["t"] + 1), F.greatest(at["start"], F.lit(0))
        own = lambda w: F.struct(at["start"].alias("start"), size.alias("size"), F.element_at(names, at["t"] + 1).alias("license"), dice(w).alias("dice"))

        def dice(window: Column) -> Column:
            bound, target = F.element_at(bounds, at["t"] + 1), F.element_at(grams, at["t"] + 1)
            both = 2.0 * F.size(F.array_intersect(window, target)) / (F.size(window) + F.size(target))
            return F.when(F.size(window).between(bound["low"], bound["high"]), both).otherwise(0.0)

        return let(F.array_distinct(F.slice(pairs, first + 1, F.greatest(at["start"] + size - first, F.lit(0)))), own)

    def windows(pairs: Column, present: Column) -> Column:
        hits = F.filter(F.transform(pairs, lambda g, k: F.struct(g.alias("g"), k.alias("k"))), lambda x: F.array_contains(present, x["g"]))
        spots = F.flatten(F.transform(hits, lambda x: F.transform(F.element_at(by_head, x["g"]), lambda p: F.struct(p["t"].alias("t"), (x["k"] - p["at"]).alias("start")))))
        return F.filter(F.transform(F.array_distinct(spots), lambda at: compared(pairs, at)), lambda m: m["dice"] >= least).cast(row)

    rank = lambda m: F.struct(-m["dice"], -m["size"], m["license"], m["start"])
    overlap = lambda x, y: (x["start"] <= y["start"] + y["size"]) & (y["start"] <= x["start"] + x["size"])
    best = lambda found: F.array_sort(F.filter(F.array_distinct(found), lambda x: ~F.exists(found, lambda y: overlap(x, y) & (rank(y) < rank(x)))))
    none = F.array().cast(row)

    def pairs_of(words: Column) -> Column:
        pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
        searched = lambda p: let(F.array_intersect(p, heads), lambda present: F.when(F.size(present) > 0, let(windows(p, present), best)).otherwise(none))
        return F.when((F.size(words) > 1) & F.arrays_overlap(words, rare), let(pairs, searched)).otherwise(none)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), let(_words(F.col("text")), pairs_of).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_notices, licenses, best_dice): names in order, comma-joined; no match: empty and 0."""
    names = F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"])))
    best = F.coalesce(F.array_max(F.transform("found", lambda m: m["dice"])), F.lit(0.0))
    return found.select("doc_id", F.size("found").cast("long").alias("n_notices"), F.array_join(names, ",").alias("licenses"), F.round(best, 6).alias("best_dice"))


def oracle_sql(least: float = 0.8) -> str:
    """DuckDB SQL for ``digest(scan(documents))``, without the size bounds."""
    quoted = lambda g: "'" + g.replace("'", "''") + "'"
    table = template_table(TEMPLATES)
    rows = ", ".join(f"({k}, '{n}', {len(g)}, [{', '.join(map(quoted, dict.fromkeys(g)))}])" for k, (n, g) in enumerate(table))
    heads = ", ".join(f"({quoted(g)}, {t}, {at})" for g, t, at in heads_of(table, least))
    return f"""
WITH t(id, license, size, grams) AS (VALUES {rows}),
h(g, id, place) AS (VALUES {heads}),
w AS (
  SELECT row_number() OVER () AS row, doc_id,
    string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
  FROM documents
),
b AS (SELECT row, doc_id, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS b FROM w),
p AS (SELECT row, unnest(b) AS g, generate_subscripts(b, 1) - 1 AS k FROM b),
c AS (SELECT DISTINCT p.row, h.id, p.k - h.place AS start FROM p JOIN h ON p.g = h.g),
s AS (
  SELECT c.row, c.start, t.size, t.license, t.grams, list_distinct(b.b[greatest(c.start, 0) + 1 : c.start + t.size]) AS x
  FROM c JOIN t ON c.id = t.id JOIN b ON c.row = b.row
),
m AS (
  SELECT DISTINCT row, start, size, license, 2.0::DOUBLE * len(list_intersect(x, grams)) / (len(x) + len(grams)) AS dice
  FROM s WHERE 2.0::DOUBLE * len(list_intersect(x, grams)) / (len(x) + len(grams)) >= {least}
),
f AS (
  SELECT * FROM m AS x WHERE NOT EXISTS (
    SELECT 1 FROM m AS y
    WHERE y.row = x.row AND x.start <= y.start + y.size AND y.start <= x.start + x.size
      AND (-y.dice, -y.size, y.license, y.start) < (-x.dice, -x.size, x.license, x.start)
  )
)
SELECT b.doc_id AS doc_id, count(f.start) AS n_notices,
  coalesce(array_to_string(list_sort(list_distinct(list(f.license) FILTER (WHERE f.license IS NOT NULL))), ','), '') AS licenses,
  coalesce(round(max(f.dice), 6), 0.0)::DOUBLE AS best_dice
FROM b LEFT JOIN f ON b.row = f.row
GROUP BY b.row, b.doc_id
"""
