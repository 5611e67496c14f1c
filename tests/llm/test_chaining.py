import random

import numpy as np
import pyarrow as pa
import pytest

from llm_util import DOCS, docs_frame, messy, words_of
from veilwork.llm import chaining, queries
from veilwork.llm.textbytes import Texts, Words
from veilwork.session import materialize


def words_like(draw, n):
    return draw.choices([f"{a}{b}" for a in "abcdefghij" for b in range(60)], k=n)


@pytest.mark.parametrize("seed", range(3))
def test_fenwick_chains_score_as_the_plain_recurrence(seed):
    draw = random.Random(seed)
    at = sorted((draw.randrange(60), draw.randrange(60)) for _ in range(40))
    b, a = (np.array(x) for x in zip(*at, strict=True))
    best = [1.0] * len(at)
    for i in range(len(at)):
        for j in range(i):
            if b[j] < b[i] and a[j] < a[i]:
                best[i] = max(best[i], 1.0 + best[j] - chaining.GAP * (b[i] - b[j] + a[i] - a[j]))
    paths = chaining.chain(b, a)
    first = paths[0]
    score = len(first) - chaining.GAP * (b[first[-1]] - b[first[0]] + a[first[-1]] - a[first[0]])
    assert score == pytest.approx(max(best))
    for p in paths:
        assert (np.diff(b[p]) > 0).all() and (np.diff(a[p]) > 0).all()
    used = np.concatenate(paths)
    assert len(set(used.tolist())) == len(used)


def test_equal_runs_share_a_seed():
    draw = random.Random(1)
    run = words_like(draw, chaining.K + chaining.WINDOW - 1)
    for _ in range(50):
        texts = [" ".join(words_like(draw, draw.randrange(0, 30)) + run + words_like(draw, draw.randrange(0, 30))) for _ in range(2)]
        raw = "".join(texts).encode()
        found = chaining.seeds(Words(Texts(np.frombuffer(raw, dtype=np.uint8), np.cumsum([0, *[len(t.encode()) for t in texts]]))))
        own = [set(found[2][found[0] == i].tolist()) for i in (0, 1)]
        assert own[0] & own[1]


def test_planted_passages(spark):
    draw = random.Random(2)
    passage = words_like(draw, 60)
    fuzzy = list(passage)
    for at in (12, 30, 31, 47):
        fuzzy[at] = "changed"
    short = words_like(draw, 30)
    texts = []
    for i in range(30):
        texts.append(words_like(draw, 40) + (passage if i < 8 else fuzzy if i < 12 else short if i < 20 else []) + words_like(draw, 50))
    whole = " ".join(words_like(draw, 70))
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)] + [(50, whole, "s"), (51, whole.upper(), "s"), (52, whole, "s")]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    ids = {r["doc_id"] for r in got} | {r["match_id"] for r in got}
    assert ids == {*range(12), 50, 51, 52}
    assert {(r["doc_id"], r["match_id"]) for r in got if r["doc_id"] >= 50} == {(51, 50), (52, 50)}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in got:
        parent[root(r["doc_id"])] = root(r["match_id"])
        mine = words_of(dict((i, t) for i, t, _ in rows)[r["doc_id"]])[r["first_word"] : r["end_word"]]
        assert len(mine) >= 50
        if r["doc_id"] < 8 and r["match_id"] < 8:
            assert " ".join(passage) in " ".join(mine) and r["edits"] == 0
    assert len({root(i) for i in range(12)}) == 1
    assert len(got) <= 2 * 2 * 12 + 2


def pair_with(draw, gap, *parts):
    """Two texts with the same parts, and `gap` words of their own around each."""
    out = []
    for _ in range(2):
        words = words_like(draw, gap)
        for p in parts:
            words += [*p, *words_like(draw, gap)]
        out.append(words)
    return out


@pytest.mark.parametrize(("part", "gap"), [(60, 40), (60, 60), (200, 150)])
def test_two_exact_passages_of_a_pair_are_both_found(spark, part, gap):
    draw = random.Random(5)
    head, foot = words_like(draw, part), words_like(draw, part)
    x, y = pair_with(draw, gap, head, foot)
    got = chaining.shared_passages(docs_frame(spark, [(1, " ".join(x), "s"), (2, " ".join(y), "s")])).collect()
    assert sorted((r["first_word"], r["end_word"], r["edits"]) for r in got) == [
        (gap, gap + part, 0), (2 * gap + part, 2 * gap + 2 * part, 0)
    ]
    assert all((r["match_first"], r["match_end"]) == (r["first_word"], r["end_word"]) for r in got)


@pytest.mark.parametrize("times", [12, 60])
def test_a_passage_of_repeated_lines(spark, times):
    draw = random.Random(6)
    line = words_like(draw, 12)
    x, y = pair_with(draw, 30, line * times)
    x = line + words_like(draw, 25) + x  # the line alone, earlier in one text
    got = chaining.shared_passages(docs_frame(spark, [(1, " ".join(x), "s"), (2, " ".join(y), "s")])).collect()
    spans = {r["doc_id"]: (r["first_word"], r["end_word"]) for r in got} | {r["match_id"]: (r["match_first"], r["match_end"]) for r in got}
    best = max(got, key=lambda r: (r["end_word"] - r["first_word"], -r["edits"]))  # others may lie one line off
    assert set(spans) == {1, 2} and best["end_word"] - best["first_word"] >= 12 * (times - 1) and best["edits"] == 0


def test_edited_passages_are_found(spark):
    draw = random.Random(8)
    rows = []
    for i in range(60):
        passage = words_like(draw, 100)
        other = list(passage)
        for at in draw.sample(range(100), 15):
            other[at] = f"other{at}"
        for side, part in enumerate((passage, other)):
            rows.append((2 * i + side, " ".join(words_like(draw, 30) + part + words_like(draw, 30)), "s"))
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert {r["doc_id"] // 2 for r in got} == set(range(60))
    assert all(r["doc_id"] // 2 == r["match_id"] // 2 and r["edits"] <= 15 for r in got)


def test_a_passage_over_frequent_text_is_found(spark):
    draw = random.Random(7)
    texts, pairs = [], []
    for _ in range(8):
        passage = words_like(draw, 60)
        pairs.append((len(texts), len(texts) + 1))
        for part in [passage] * 2 + [passage[:40]] * 10 + [passage[20:]] * 10:
            texts.append(words_like(draw, 30) + part + words_like(draw, 30))
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert sorted(tuple(sorted((r["doc_id"], r["match_id"]))) for r in got) == pairs
    assert {r["end_word"] - r["first_word"] for r in got} == {60}


def test_a_passage_in_many_texts_is_linear(spark):
    draw = random.Random(3)
    passage = words_like(draw, 55)
    rows = [(i, " ".join(words_like(draw, 5) + passage + words_like(draw, 5)), "s") for i in range(120)]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} | {r["match_id"] for r in got} == set(range(120))
    assert len(got) <= 2 * 120


def test_awkward_rows(spark):
    long_text = " ".join(f"z{i}" for i in range(30_000))
    rows = messy() + [(None, long_text, "s"), (20, long_text, "s"), (21, "q " + long_text, "s"), (20, long_text, "s")]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert {(r["doc_id"], r["match_id"]) for r in got} <= {(None, 20), (21, 20), (20, 21)}
    assert len(got) == 2
    assert chaining.shared_passages(spark.createDataFrame([], DOCS)).collect() == []


def test_a_common_phrase_makes_no_pairs(spark):
    draw = random.Random(9)
    phrase = words_like(draw, 7)
    texts = [words_like(draw, 100) + phrase + words_like(draw, 100) for _ in range(400)]
    df = docs_frame(spark, [(i, " ".join(t), "s") for i, t in enumerate(texts)]).selectExpr("doc_id", "text", "doc_id AS row")
    keys = chaining._keys(df)
    assert keys.count() > 20 * 400 and keys.groupBy("key").count().where("count > 1").isEmpty()


def test_fifty_equal_words_share_a_pair_of_seeds():
    draw = random.Random(10)
    for _ in range(200):
        passage = words_like(draw, chaining.LEAST)
        texts = [" ".join(words_like(draw, draw.randrange(0, 30)) + passage + words_like(draw, draw.randrange(0, 30))) for _ in range(2)]
        raw = "".join(texts).encode()
        words = Words(Texts(np.frombuffer(raw, dtype=np.uint8), np.cumsum([0, *[len(t.encode()) for t in texts]])))
        text, key = chaining.seed_pairs(*chaining.seeds(words))
        assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())


def linked(got, covers):
    """Pairs of documents with a row that covers the places, or with one each to the same document over them."""
    at = {}
    for r in got:
        for own, first, end, other in (
            (r["doc_id"], r["first_word"], r["end_word"], r["match_id"]),
            (r["match_id"], r["match_first"], r["match_end"], r["doc_id"]),
        ):
            if first <= covers[0] and covers[1] <= end:
                at.setdefault(own, set()).add(other)
    return {(x, y) for x in at for y in at if x < y and (y in at[x] or at[x] & at[y])}


def test_connected_texts_keep_their_other_passages(spark):
    """Texts 0 and 1 are connected by a passage of many; parts of their other one are in texts with more in common."""
    draw = random.Random(11)
    common, own = words_like(draw, 60), words_like(draw, 60)
    more, most = words_like(draw, 150), words_like(draw, 150)
    parts = [(common, own)] * 2 + [(common, more)] * 20 + [(own[:44], most)] * 10 + [(own[14:], most)] * 10
    rows = []
    for i, (x, y) in enumerate(parts):
        rows.append((i, " ".join(words_like(draw, 20) + x + words_like(draw, 20) + y + words_like(draw, 20)), "s"))
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert linked([r for r in got if {r["doc_id"], r["match_id"]} == {0, 1}], (100, 160)) == {(0, 1)}
    assert linked(got, (20, 80)) >= {(i, j) for i in range(22) for j in range(i + 1, 22)}


def test_short_runs_of_a_word_make_no_pairs(spark):
    """Texts share 40 times the same word, or 49 times and a neighbour of the run, or 50 times."""
    draw = random.Random(12)
    texts = [words_like(draw, 60) + ["the"] * 40 + words_like(draw, 60) for _ in range(200)]
    df = docs_frame(spark, [(i, " ".join(t), "s") for i, t in enumerate(texts)]).selectExpr("doc_id", "text", "doc_id AS row")
    keys = chaining._keys(df).select("key", "name").distinct()
    assert keys.groupBy("key").count().where("count > 3").isEmpty()

    def around(part):
        return words_like(draw, 30) + part + words_like(draw, 30)

    rows = []
    for i, (left, run, right) in enumerate([(0, 50, 0), (1, 49, 0), (0, 49, 1), (2, 46, 2), (2, 45, 3), (0, 30, 20), (13, 24, 13)]):
        part = words_like(draw, left) + [f"run{i}"] * run + words_like(draw, right)
        rows += [(2 * i, " ".join(around(part)), "s"), (2 * i + 1, " ".join(around(part)), "s")]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert {tuple(sorted((r["doc_id"], r["match_id"]))) for r in got} == {(2 * i, 2 * i + 1) for i in range(7)}


def test_every_document_with_a_passage_has_rows(spark, tmp_path):
    """Passages of two and of five documents, exact and edited copies, and a null id; `doc_id` alone tells which have one."""
    draw = random.Random(13)
    rows, planted = [], []
    for size in [2] * 20 + [5] * 4:
        passage = words_like(draw, 60)
        for _ in range(size):
            planted.append(len(rows))
            before = draw.randrange(5, 40)
            rows.append((len(rows), " ".join(words_like(draw, before) + passage + words_like(draw, 30)), "s"))
    whole, edited = words_like(draw, 80), words_like(draw, 90)
    other = [*edited[:40], "changed", *edited[41:]]
    ids = [1000, 1001, 1001, None, 1002, 1003]
    rows += [(i, " ".join(t), "s") for i, t in zip(ids, [whole, whole, whole, whole, edited, other], strict=True)]
    rows += [(2000 + i, " ".join(words_like(draw, 100)), "s") for i in range(20)]
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op8_shared_passages"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {*planted, *ids}
    texts = {i: words_of(t) for i, t, _ in rows}
    for r in got:
        if r["edits"] == 0:
            mine, match = texts[r["doc_id"]], texts[r["match_id"]]
            assert mine[r["first_word"] : r["end_word"]] == match[r["match_first"] : r["match_end"]]
    both = {(r["doc_id"], r["first_word"], r["end_word"], r["match_id"], r["match_first"], r["match_end"], r["edits"]) for r in got}
    assert both == {(*r[3:6], *r[:3], r[6]) for r in both}


@pytest.mark.parametrize("others", [7, 40])
def test_a_passage_of_words_repeated_all_over_is_found(spark, others):
    """Runs of `a` meet in more pairs of places than MATCHES; the passage's are neither the first nor the last of both."""
    draw = random.Random(14)

    def runs(*parts):
        return [word for name, n in parts for word in [name] * n]

    x = runs(*[(f"x{i}", 32) for i in range(others)], ("a", 32), ("b", 32), *[(f"u{i}", 32) for i in range(others)])
    y = runs(("a", 63), ("y0", 63), ("y1", 63), ("a", 63), ("b", 63), ("y2", 63), ("b", 63), ("a", 63))
    rows = [(1, " ".join(x), "s"), (2, " ".join(words_like(draw, 20) + y), "s")]
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    spans = {r["doc_id"]: (r["first_word"], r["end_word"]) for r in got if r["edits"] == 0}
    spans |= {r["match_id"]: (r["match_first"], r["match_end"]) for r in got if r["edits"] == 0}
    assert spans == {1: (32 * others, 32 * others + 64), 2: (20 + 63 * 4 - 32, 20 + 63 * 4 + 32)}


def test_texts_with_one_short_phrase_in_common_are_not_paired(spark, monkeypatch):
    draw = random.Random(12)
    phrase = words_like(draw, 45)
    rows = [(i, " ".join(words_like(draw, 30) + phrase + words_like(draw, 30)), "s") for i in range(40)]
    passage = words_like(draw, 60)
    rows += [(100 + i, " ".join(words_like(draw, 9) + phrase + words_like(draw, 9) + passage), "s") for i in range(3)]
    written = {}

    def kept(df, name):
        written[name] = materialize(df, name)
        return written[name]

    monkeypatch.setattr(chaining, "materialize", kept)
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} | {r["match_id"] for r in got} == {100, 101, 102}
    assert written["loose"].count() > 40 and written["pairs"].count() <= 3


def odd_texts(draw, n):
    """Texts with phrases in common, edited, repeated and cut, and runs of one word."""
    phrases = [words_like(draw, draw.randrange(24, 60)) for _ in range(4)] + [["the"] * 30, ["of"] * 40, words_like(draw, 3) * 12]
    texts = []
    for _ in range(n):
        words = words_like(draw, draw.randrange(0, 15))
        for _ in range(draw.randrange(1, 4)):
            part = list(draw.choice(phrases))
            for at in draw.sample(range(len(part)), draw.choice([0, 0, 1, 3])):
                part[at] = draw.choice(["other", "the", part[at - 1]])
            words += part[draw.choice([0, 0, 3]) :] + words_like(draw, draw.randrange(0, 12))
        texts.append(words)
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_no_pair_with_a_passage_is_left_out(monkeypatch, seed):
    draw = random.Random(seed)
    values = {}
    texts = odd_texts(draw, 40)
    packed = [np.array([values.setdefault(w, len(values)) for w in t], dtype=np.uint32).tobytes() for t in texts]
    place = np.array([draw.randrange(max(1, len(t) - 24)) for t in texts])
    row = np.arange(len(texts))
    left, right = chaining.likely_pairs(packed, place, row, row)
    likely = set(zip(left.tolist(), right.tolist(), strict=True))
    short = [chaining.passages_of(x, y) for x in packed for y in packed]
    monkeypatch.setattr(chaining, "may_share", lambda x, y: True)
    whole = [chaining.passages_of(x, y) for x in packed for y in packed]
    assert short == whole
    pairs = {(i // len(texts), i % len(texts)) for i, found in enumerate(whole) if found and i // len(texts) != i % len(texts)}
    assert 10 < len(pairs) and pairs <= likely and len(likely) < 0.9 * len(texts) ** 2


@pytest.mark.parametrize("most", [4, 15, 512])
def test_texts_of_a_crowded_phrase_meet_in_cells(spark, monkeypatch, most):
    draw = random.Random(9)
    rows = [(i, " ".join(t), "s") for i, t in enumerate(odd_texts(draw, 60))]
    want = sorted(map(tuple, chaining.shared_passages(docs_frame(spark, rows)).collect()))
    monkeypatch.setattr(chaining, "CELL", most)
    got = chaining.shared_passages(docs_frame(spark, rows)).collect()
    assert len(want) > 50 and sorted(map(tuple, got)) == want


@pytest.mark.parametrize("most", [0, 1, 5, 1 << 18])
def test_meetings_stream_over_batch_ends(most):
    draw = random.Random(most)
    keys = [k << chaining.LOW for k in range(-20, 20)] + [(k << chaining.LOW) + 5 for k in range(6)] + [7, 9]
    names = [draw.randrange(-(1 << 40), 1 << 40) for _ in range(9)] + [3, (1 << chaining.LOW) + 3, (5 << chaining.LOW) + 3]
    rows = [(draw.choice(keys), draw.choice(names), draw.randrange(50)) for _ in range(150)] + [(keys[3], n, p) for n in names for p in (4, 2)]
    want = {}
    for k, n, p in rows:
        if len({x for q, x, _ in rows if q == k}) > 1:
            want[k, n] = min(p, want.get((k, n), p))
    low = (1 << chaining.LOW) - 1
    rows.sort(key=lambda r: (r[0] & ~low) | (r[1] & low))
    for size in (1, 2, 7, 1000):
        cut = [rows[i : i + size] for i in range(0, len(rows), size)]
        kinds = (pa.int64(), pa.int64(), pa.int32())
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], ["key", "name", "place"]) for part in cut]
        got = [tuple(r.values()) for b in chaining._meetings(iter(batches), most) for r in b.to_pylist()]
        assert sorted(got) == sorted((k, n, p) for (k, n), p in want.items()), size
