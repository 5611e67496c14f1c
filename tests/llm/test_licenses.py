import random
from collections import Counter

import pytest

from llm_util import DOCS, docs_frame, messy
from veilwork.llm import licenses

NOTICE = "This work is licensed under the GNU General Public License, version 3."


def plain_words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text).split()


def dice(a, b):
    x, y = (Counter(zip(w, w[1:], strict=False)) for w in (a, b))
    return 2 * sum((x & y).values()) / max(1, sum(x.values()) + sum(y.values()))


@pytest.mark.parametrize("seed", range(2))
def test_windows_are_the_best_of_all(seed):
    import pyarrow as pa

    draw = random.Random(seed)
    pool = "released under the mit license some other words of the".split()
    texts = [" ".join(draw.choices(pool, k=draw.randrange(0, 25))) for _ in range(200)]
    t = licenses.Template("MIT", "Released under the MIT License.", 0.8)
    got = licenses.scan_texts(pa.array(texts), [t], 0.8)
    goal = plain_words("Released under the MIT License.")
    for text, found in zip(texts, got, strict=True):
        w = text.split()
        best = max([dice(w[i:j], goal) for i in range(len(w)) for j in range(i + 2, len(w) + 1)], default=0)
        assert (best >= 0.8) == bool(found)
        if found:
            assert max(f["dice"] for f in found) == pytest.approx(best)
            for f in found:
                assert dice(w[f["first_word"] : f["last_word"] + 1], goal) == pytest.approx(f["dice"])


def test_notices_are_found_anywhere(spark):
    filler = "lorem ipsum dolor sit amet " * 2000
    texts = [
        (1, NOTICE, "a"), (2, filler + NOTICE.upper() + " " + filler, "a"), (3, "x " + NOTICE.replace("GNU ", "GNU\n\n"), "a"),
        (4, filler, "a"), (5, "All rights reserved. Then\nReleased under the MIT License.", "a"),
        (6, "the license of the work", "a"), (7, NOTICE.replace("work", "book"), "a"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs_frame(spark, texts)).collect()}
    assert {i: r["license"] for i, r in got.items()} == {
        1: "GPL-3.0", 2: "GPL-3.0", 3: "GPL-3.0", 4: None, 5: "All-Rights-Reserved", 6: None, 7: "GPL-3.0"
    }
    assert [n["license"] for n in got[5]["notices"]] == ["All-Rights-Reserved", "MIT"]
    assert got[1]["dice"] == 1.0 and got[7]["dice"] < 1.0


def test_near_licences_are_told_apart():
    import pyarrow as pa

    gnu = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    cc = "This work is licensed under a Creative Commons {} License."
    texts = [
        (gnu.format("General Public License", 2), "GPL-2.0"), (gnu.format("General Public License", 3), "GPL-3.0"),
        (gnu.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
        (gnu.format("Lesser General Public License", 3), "LGPL-3.0"),
        (gnu.format("Affero General Public License", 3), "AGPL-3.0"),
        (NOTICE.replace("3", "2"), "GPL-2.0"), (NOTICE.replace("3", "7"), None), (NOTICE, "GPL-3.0"),
        (cc.format("Attribution 3.0 Unported"), "CC-BY-3.0"), (cc.format("Attribution 4.0 International"), "CC-BY-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n\n Copyright (C) 1989", "GPL-2.0"),
    ]
    known = [licenses.Template(n, t, 0.8) for n, t in licenses.TEMPLATES]
    found = licenses.scan_texts(pa.array([f"some words {t} more words" for t, _ in texts]), known, 0.8)
    assert [max(f, key=lambda x: x["dice"])["license"] if f else None for f in found] == [n for _, n in texts]


def test_every_template_finds_itself(spark):
    texts = [(i, t, n) for i, (n, t) in enumerate(licenses.TEMPLATES)]
    for r in licenses.scan_licenses(docs_frame(spark, texts)).collect():
        assert r["license"] == texts[r["doc_id"]][2] and r["dice"] == 1.0


def test_awkward_rows(spark):
    rows = messy()
    got = licenses.scan_licenses(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(r["license"] is None and r["notices"] == [] for r in got)
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []
