import numpy as np
import pytest
from pyspark.sql import functions as F

from veilwork.llm import ann

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(ids, x, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS).withColumn("leaf", F.lit(1)).withColumn("v", F.lit("x"))
    got: dict = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(30, 16))
    x = (centres[draw.integers(0, 30, 4000)] + 0.4 * draw.normal(size=(4000, 16))) * draw.uniform(0.5, 2, (4000, 1))
    x = x.astype(np.float32).astype(np.float64)
    ids = draw.permutation(4000)
    got = run(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], sample_rows=2000)
    want = brute(ids, x, 20)
    assert got.keys() == want.keys()
    found = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.9
    place = {int(i): n for n, i in enumerate(ids)}
    for q in list(got)[:20]:
        for i, s in got[q]:
            assert s == pytest.approx(float(x[place[q]] @ x[place[i]]), rel=1e-12)


def test_few_leaves_are_visited(spark):
    draw = np.random.default_rng(3)
    centres = 8 * draw.normal(size=(64, 8))
    x = ann.lift(centres[draw.integers(0, 64, 5000)] + 0.1 * draw.normal(size=(5000, 8)), 100.0)
    tree = ann.fit_tree(x, 64)
    assert tree.leaves > 40
    assert ann.calibrate(tree, x, np.arange(100), 10, 0.95) < tree.leaves / 4
    order = list(tree.order(x[0]))
    assert sorted(order) == list(range(tree.leaves))


def test_equal_vectors_tie_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    rows = [(i, [1.0, 2.0, 0.5], 0) for i in range(400)] + [(1000 + i, [float(-i), 1.0, 0.0], 1) for i in range(1, 60)]
    got = run(spark, rows)
    assert [i for i, _ in got[0]] == list(range(1, 21))
    assert [i for i, _ in got[40]] == list(range(20))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (20, [0.5, 0.5], 0), (3, None, 0), (40, [0.0, 0.0], 0), (60, [nan, 1.0], 0), (80, [inf, 1.0], 0),
        (100, [1.0, None], 0), (120, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (7, [2.0, 0.0], 0), (7, [2.0, 0.0], 0),
        (140, [], 0), (9, [3.0, 1.0], None), (9, [3.0, 0.5], None),
    ]
    got = run(spark, rows)
    assert got == {0: [(9, 3.0), (7, 2.0), (20, 0.5)], 20: [(9, 1.75), (7, 1.0), (0, 0.5)]}
    assert run(spark, []) == {}
    assert run(spark, [(20, [1.0], 0)]) == {}
    assert run(spark, [(20, None, 0)]) == {}
