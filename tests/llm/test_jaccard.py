import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_util import DOCS, docs_frame, messy, words_of
from veilwork.llm import cells, jaccard
from veilwork.llm.graph import components


def plain(rows, words, percent):
    """(set size, smallest reachable id) by comparing all pairs."""
    sets = []
    for _, text, _ in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), (min(ids) if ids else None) if sets[i] else rows[i][0]))
    return sorted(out, key=str)


def near_copies(seed):
    draw = random.Random(seed)
    rows, number = [], 0
    for _ in range(12):
        base = draw.choices([f"v{i}" for i in range(400)], k=draw.choice([2, 5, 9, 30, 60, 150, 400]))
        for _ in range(draw.randrange(1, 14)):
            words = list(base)
            for _ in range(draw.randrange(0, 1 + len(words) // 25)):
                at = draw.randrange(len(words))
                words[at : at + draw.choice([0, 1, 1])] = draw.choice([[], ["new"], [f"v{draw.randrange(400)}"]])
            rows.append((number, " ".join(words), "s"))
            number += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "words", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_same_components_as_all_pairs(spark, seed, words, percent):
    rows = near_copies(seed)
    got = jaccard.similar_components(docs_frame(spark, rows), words, percent).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, words, percent)


@pytest.mark.parametrize("percent", (60, 80, 85, 95))
def test_linked_sets_share_a_piece(percent):
    draw = np.random.default_rng(percent)
    bands = jaccard.Bands(percent)
    linked = 0
    for _ in range(1500):
        size = int(draw.integers(1, 300))
        a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.delete(a, draw.choice(len(a), int(draw.integers(0, max(1, len(a) // 6) + 1)), replace=False))
        b = np.unique(np.concatenate([b, draw.integers(0, 1 << 63, int(draw.integers(0, max(1, len(a) // 8) + 1)), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        either = len(a) + len(b) - common
        if common == either or 100 * common < percent * either:
            continue
        linked += 1
        assert np.intersect1d(jaccard.pieces(a, bands), jaccard.pieces(b, bands)).size
        assert either - common <= bands.difference(len(a) + len(b))
    assert linked > 20


def test_hamming_is_at_most_the_difference(spark):
    draw = np.random.default_rng(4)
    rows, want = [], []
    for _ in range(60):
        a = np.unique(draw.integers(0, 1 << 63, int(draw.integers(1, 200)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) * 9 // 10], draw.integers(0, 1 << 63, 1 + len(a) // 10, dtype=np.uint64)]))
        rows.append((jaccard.bit_sketch(a).tolist(), jaccard.bit_sketch(b).tolist()))
        want.append(len(np.setxor1d(a, b)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<long>, b array<long>")
    got = dict(map(tuple, df.select("i", jaccard.hamming(df["a"], df["b"])).collect()))
    assert all(got[i] <= w for i, w in enumerate(want)) and sum(got.values()) > 0.3 * sum(want)


def test_meetings_stream_over_batch_ends():
    draw = random.Random(3)
    rows = sorted((draw.randrange(40), draw.randrange(12)) for _ in range(300))
    want = sorted(
        {(k, n) for k, n in rows if len({x for q, x in rows if q == k}) > 1}
    )
    for size in (1, 2, 7, 1000):
        cut = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in c], pa.int64()), pa.array([r[1] for r in c], pa.int64())], ["key", "name"]) for c in cut]
        got = [tuple(r.values()) for b in jaccard._meetings(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == want, size


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500), (7, None), (200, 199)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_awkward_rows(spark):
    rows = messy()
    got = jaccard.similar_components(docs_frame(spark, rows), 4, 85).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 4, 85)
    assert jaccard.similar_components(spark.createDataFrame([], DOCS)).collect() == []
    kept = jaccard.one_of_each(docs_frame(spark, rows)).collect()
    assert [r["doc_id"] for r in kept if r["text"] == rows[5][1]] == [5]
    assert len(kept) == len(rows) - 2 and set(kept[0].asDict()) >= {"row", "component", "doc", "n"}


def test_one_row_stays_of_repeated_rows(spark):
    same = "one two three four five six seven"
    rows = [(1, same, "a"), (1, same, "b"), (None, same, "c"), (2, "other text", "a"), (3, "", "a"), (3, "", "a")]
    kept = jaccard.one_of_each(docs_frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, same), (2, "other text"), (3, ""), (3, "")]


@pytest.mark.parametrize(("most", "few"), [(5, 0), (5, 48), (40, 0), (1000, 0), (1000, 48)])
def test_sets_of_a_crowded_piece_are_compared_in_cells(spark, monkeypatch, most, few):
    monkeypatch.setattr(jaccard, "blocks_of", lambda rows: cells.blocks_of(rows, most))
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "STEP", 64)
    draw = np.random.default_rng(most)
    base = np.unique(draw.integers(0, 1 << 63, 70, dtype=np.uint64))
    sets = []
    for i in range(60):
        own = draw.integers(0, 1 << 63, int(draw.integers(0, 30)), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([draw.choice(base, int(draw.integers(40, 70)), replace=False), own])))
        if i % 5 == 0:
            sets.append(np.append(sets[-1][:-3], own[:1]))
    sets = {jaccard.name_of(one): one for one in sets}
    names = sorted(sets)
    component = {n: names[0] if i % 3 == 0 else n for i, n in enumerate(names)}
    of_key = {1: names, 2: names[:7], 3: names[5:6] + names[9:10], 4: names[::3]}
    met = spark.createDataFrame([(k, n) for k, of in of_key.items() for n in of], "key long, name long")
    found = spark.createDataFrame([(n, c) for n, c in component.items() if n != c or n == names[0]], "node long, component long")
    reps = spark.createDataFrame([(n, len(s), jaccard.bit_sketch(s).tolist()) for n, s in sets.items()], "name long, n long, sketch array<long>")
    pairs = [(a, b) for of in of_key.values() for a in of for b in of if a < b and component[a] != component[b]]
    facts = reps.select("name", F.struct("n", "sketch").alias("f"))
    want = spark.createDataFrame(pairs, "a long, b long").distinct()
    want = want.join(facts.toDF("a", "fa"), "a").join(facts.toDF("b", "fb"), "b").where(jaccard._may_link("fa", "fb", 60)).select("a", "b")
    got = jaccard._unjoined(met, found, reps, 60)
    assert 20 < want.count() < len(set(pairs))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_join_makes_the_pairs_of_a_crowded_piece(spark):
    met = spark.createDataFrame([(1, n) for n in range(300)], "key long, name long")
    found = spark.createDataFrame([], "node long, component long")
    reps = spark.createDataFrame([(n, 1, [1 << (n % 60)]) for n in range(300)], "name long, n long, sketch array<long>")
    pairs = jaccard._unjoined(met, found, reps, 80)
    assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()
