"""Find licence notices by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.llm.textbytes import LOWER, Texts, Words, as_texts, chunks, grams

_BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""

# Licence names and their notices, as published by their authors.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version."""),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
International License."""),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("All-Rights-Reserved", "All rights reserved."),
    *[
        (f"{name}-{version}.0", f"""This {work} is free software{mark} you can redistribute it and/or modify it under the terms
of the GNU {title} as published by the Free Software Foundation{mid} either version {version} of the
License, or (at your option) any later version.""")
        for name, title, version in (
            ("GPL", "General Public License", 2), ("LGPL", "Lesser General Public License", 3),
            ("LGPL", "Library General Public License", 2), ("AGPL", "Affero General Public License", 3),
        )
        for work, mark, mid in (("program", ":", ","), ("library", ";", ";"))
    ],
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of
the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1
of the License, or (at your option) any later version."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    # Whole licences by their heads.
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + """ Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission."""),
    *[
        (f"CC-{short}-{version}.0", text)
        for short, long in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for version, kind in ((3, "Unported"), (4, "International"))
        for text in (
            f"Licensed under CC {short} {version}.0.",
            f"This work is licensed under a Creative Commons {long} {version}.0 {kind} License.",
        )
    ],
)

# Words that tell versions and names apart: a window has the same of them as the template. Digits
# count where the template has one, names in the family that its words show.
DIGITS = tuple("123456789")
NAMES = (
    ({"gnu"}, ("lesser", "affero")),
    ({"cc", "creative"}, ("sharealike", "sa", "noncommercial", "nc", "noderivatives", "noderivs", "nd")),
)

# Normal form: A-Z lower-cased, words are runs of a-z, 0-9 and characters beyond ASCII.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[128:] = False
for _a, _z in ("az", "AZ", "09"):
    NOT_WORD[ord(_a) : ord(_z) + 1] = False

FOUND = "array<struct<license:string,dice:double,first_word:int,last_word:int>>"


_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hash(word: str) -> int:
    raw = word.encode()
    return int(Words(Texts(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])), NOT_WORD, LOWER).hashes[0])


class Template:
    """One notice: its bigrams with counts, and the sizes and overlaps that can reach `least`."""

    def __init__(self, name: str, text: str, least: float):
        raw = text.encode()
        words = Words(Texts(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])), NOT_WORD, LOWER)
        self.name = name
        self.bigrams = Counter(grams(words.hashes, 2).tolist())
        self.size = sum(self.bigrams.values())
        # Dice 2 c / (size + s) >= least with c <= size and c <= s bounds both s and c.
        self.longest = math.floor((2 - least) / least * self.size + 1e-9)
        self.overlap = max(1, math.ceil(least / (2 - least) * self.size - 1e-9))
        own = {raw[a:z].decode().translate(_LOW) for a, z in zip(words.begin.tolist(), words.end.tolist(), strict=True)}
        telling = [w for family, names in NAMES if own & family for w in names]
        # BSD numbers its conditions, and not in every copy.
        telling += DIGITS if own.intersection(DIGITS) and not name.startswith("BSD") else ()
        self.telling = frozenset(map(_hash, telling))
        self.tells = frozenset(_hash(w) for w in telling if w in own)


def best_windows(
    at: np.ndarray, grams_at: list[int], t: Template, least: float, marks: Sequence[tuple[int, int]] = ()
) -> list[tuple[float, int, int]]:
    """Non-overlapping windows of bigrams (dice, first, last) with Dice of `least` or more.

    marks: (place, hash) of the text's telling words; a window has those of the template.
    """
    marks = [m for m in marks if m[1] in t.telling]
    reach = np.searchsorted(at, at + t.longest)
    starts = np.flatnonzero(reach - np.arange(len(at)) >= t.overlap)
    found = []
    for i in starts.tolist():
        seen: Counter = Counter()
        common, best = 0, (0.0, 0, 0)
        told: set = set()
        mark = bisect_left(marks, (int(at[i]), 0))
        for j in range(i, int(reach[i])):
            while mark < len(marks) and marks[mark][0] <= at[j] + 1:
                told.add(marks[mark][1])
                mark += 1
            if not told <= t.tells:
                break
            g = grams_at[j]
            seen[g] += 1
            common += seen[g] <= t.bigrams[g]
            dice = 2 * common / (t.size + int(at[j] - at[i]) + 1)
            if dice > best[0] and told == t.tells:
                best = (dice, int(at[i]), int(at[j]))
        if best[0] >= least:
            found.append(best)
    return spread_out(found)


def spread_out(found: list) -> list:
    """The best of overlapping windows; items are (dice, first, last, ...)."""
    out: list = []
    for x in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1:])):
        if all(x[2] < y[1] or x[1] > y[2] for y in out):
            out.append(x)
    return out


def scan_texts(column: pa.Array, templates: Sequence[Template], least: float) -> list[list[dict]]:
    """The notices in every text of a column."""
    words = Words(as_texts(column), NOT_WORD, LOWER)
    pairs = grams(words.hashes, 2)
    owner = words.owner()
    known = np.array(sorted({g for t in templates for g in t.bigrams}), dtype=np.uint64)
    if not len(pairs) or not len(known):
        return [[] for _ in range(len(column))]
    place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    hits = np.flatnonzero((known[place] == pairs) & (owner[:-1] == owner[1:]))
    telling = np.array(sorted({w for t in templates for w in t.telling}), dtype=np.uint64)
    marked = np.flatnonzero(np.isin(words.hashes, telling))
    edges = np.searchsorted(marked, words.first)
    out: list[list] = [[] for _ in range(len(column))]
    for t in templates:
        own = hits[np.isin(pairs[hits], np.array(list(t.bigrams), dtype=np.uint64))]
        docs, first, number = np.unique(owner[own], return_index=True, return_counts=True)
        for d, f, n in zip(docs.tolist(), first.tolist(), number.tolist(), strict=True):
            if n >= t.overlap:
                at = own[f : f + n]
                own_marks = marked[edges[d] : edges[d + 1]] if t.telling else marked[:0]
                marks = list(zip((own_marks - words.first[d]).tolist(), words.hashes[own_marks].tolist(), strict=True))
                found = best_windows(at - words.first[d], pairs[at].tolist(), t, least, marks)
                out[d] += [(dice, a, b + 1, t.size, t.name) for dice, a, b in found]
    return [
        [
            {"license": name, "dice": dice, "first_word": a, "last_word": b}
            for dice, a, b, _, name in sorted(spread_out(found), key=lambda x: x[1])
        ]
        for found in out
    ]


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Notices in every whole text: (doc_id, license, dice, n_notices, notices).

    A window of words is a notice if the Dice coefficient of its bigrams and a template's
    (as multisets) is at least `least`. The bigrams of all templates pick the places to
    look at; a template is tried only where enough of its bigrams lie within the longest
    window that its size allows. A window has the same digits and names (lesser, affero, nc,
    ...) as the template, where these tell licences apart. Of overlapping windows the best stays, then the longer.
    `license` is the best notice's, the first one on ties.

    One row per input row, in one pass without a shuffle. The templates are a parameter and
    travel with the task. A null or empty text has no notices and a null license.
    """
    known = [Template(name, text, least) for name, text in templates]
    known = [t for t in known if t.size]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = scan_texts(part.column(1), known, least)
                best = [max(f, key=lambda x: (x["dice"], -x["first_word"]), default={}) for f in found]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column(0),
                        "license": pa.array([b.get("license") for b in best], pa.string()),
                        "dice": pa.array([b.get("dice") for b in best], pa.float64()),
                        "n_notices": pa.array([len(f) for f in found], pa.int32()),
                        "notices": pa.array(
                            found,
                            pa.list_(pa.struct([
                                ("license", pa.string()), ("dice", pa.float64()),
                                ("first_word", pa.int32()), ("last_word", pa.int32()),
                            ])),
                        ),
                    }
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, license string, dice double, n_notices int, notices {FOUND}")
