import random

import numpy as np
import pyarrow as pa
import pytest

from llm_util import DOCS, docs_frame, messy
from veilwork.llm import decontam

ITEMS = "item_id long, text string"


def sentence(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnopqrst", k=draw.randrange(2, 9))) for _ in range(n))


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        out[at : at + draw.choice([0, 1, 1])] = draw.choice([[], ["x"], ["y"]])
    return "".join(out)


def fewest_edits(p, t):
    """Semi-global edit distance, the plain way."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(3))
def test_no_passage_within_the_budget_is_missed(seed):
    draw = random.Random(seed)
    items = [(i, sentence(draw, draw.randrange(6, 22))) for i in range(12)]
    known = decontam.Passages(items, decontam.EDITS)
    texts = []
    for _ in range(40):
        i = draw.randrange(12)
        body = edited(draw, items[i][1], draw.randrange(0, 14))
        texts.append(sentence(draw, draw.randrange(0, 20)) + " " + body + " " + sentence(draw, draw.randrange(0, 20)))
    found = decontam.leaks(pa.array(texts), known, known.filter())
    forms = decontam.normal(pa.array(texts))
    hits = 0
    for t in range(len(texts)):
        form = forms.data[forms.starts[t] : forms.starts[t + 1]].tobytes()
        for p in range(len(known.text)):
            got = dict(found[t].get(known.item[p], [])).get(p)
            want = fewest_edits(known.text[p].tobytes(), form)
            assert got == (want if want <= known.budget[p] else None)
            hits += got is not None
    assert hits > 10


def test_many_texts_times_many_passages():
    """Text number times passages beyond 2^31, without an index of that size."""
    draw = random.Random(12)
    item = sentence(draw, 12)
    known = decontam.Passages([(5, item)], decontam.EDITS)
    many = 300_000  # the item's passage is the last of so many
    known.text = [known.text[0]] * many
    known.size, known.budget, known.bound = (np.full(many, x[0]) for x in (known.size, known.budget, known.bound))
    known.passage = np.full(len(known.passage), many - 1)
    texts = ["x"] * 8000 + [item]
    form = decontam.normal(pa.array(texts))
    text, passage, bins = decontam.candidates(form, known, known.filter())
    assert set(text.tolist()) == {8000} and set(passage.tolist()) == {many - 1} and (bins >= 0).all()


def test_banded_alignment_is_the_plain_distance_within_the_band():
    draw = random.Random(9)
    for _ in range(30):
        p = sentence(draw, 5).encode()
        t = edited(draw, p.decode(), 3).encode()
        region = np.zeros((1, len(p) + 20), dtype=np.uint8)
        region[0, 6 : 6 + len(t)] = np.frombuffer(t, dtype=np.uint8)
        got = decontam.align(np.frombuffer(p, dtype=np.uint8), region, 21)[0]
        assert got == fewest_edits(p, region[0].tobytes())


def test_planted_items_and_clean_documents(spark):
    draw = random.Random(4)
    items = [(i, sentence(draw, 35)) for i in range(6)]
    bench = spark.createDataFrame([*items, (None, sentence(draw, 30)), (7, None), (8, "too short")], ITEMS)
    noise = [sentence(draw, 200) for _ in range(20)]
    rows = [(i, t, "s") for i, t in enumerate(noise)]
    rows += [
        (30, noise[0] + " " + items[0][1].upper() + "!! " + noise[1], "s"),
        (31, items[1][1].replace(" ", " \n*** "), "s"),
        (32, noise[2] + edited(draw, items[2][1], 4) + noise[3], "s"),
        (33, noise[4] + " " + items[3][1][40:] + " " + noise[5], "s"),
        (34, items[4][1] + " " + items[5][1], "s"), (34, items[4][1] + " " + items[5][1], "s"),
        (35, "too short", "s"),
    ]
    docs = docs_frame(spark, rows)
    got = decontam.find_leaks(docs, bench).collect()
    assert sorted({(r["doc_id"], r["item_id"]) for r in got}) == [(30, 0), (31, 1), (32, 2), (33, 3), (34, 4), (34, 5)]
    assert len(got) == 8 and {r["edits"] for r in got if r["doc_id"] in (30, 31)} == {0}
    kept = decontam.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(20), 35]


def test_benchmarks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    draw = random.Random(6)
    items = [(i, sentence(draw, 20)) for i in range(9)]
    docs = docs_frame(spark, [(i, "x " + t, "s") for i, t in items])
    bench = spark.createDataFrame(items, ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()} == {(i, i) for i in range(9)}
    assert decontam.without_leaks(docs, bench).collect() == []


def test_awkward_rows(spark):
    rows = messy()
    docs = docs_frame(spark, rows)
    bench = spark.createDataFrame([(1, "x"), (2, None), (3, "")], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    for items in (bench, none):
        assert decontam.find_leaks(docs, items).collect() == []
        assert len(decontam.without_leaks(docs, items).collect()) == len(rows)
        assert decontam.find_leaks(spark.createDataFrame([], DOCS), items).collect() == []
