import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm_util import DOCS, docs_frame, messy
from veilwork.llm import toxicity

BAD = ["zork", "blarg", "vile", "scum"]


def corpus(n, seed=1):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = draw.choices([f"w{j}" for j in range(300)], k=draw.randrange(3, 120))
        bad = draw.random() < 0.2
        if bad:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD).upper())
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_sparsity(spark):
    rows, labels = corpus(1500)
    docs = docs_frame(spark, rows)
    train = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int")
    weights = toxicity.fit(docs, train, "toxic")
    assert 0 < len(weights) < 500
    again = toxicity.fit(docs.repartition(5), train.repartition(3), "toxic")
    assert weights == again
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, weights, keep=["doc_id"]).collect()}
    held = [(got[i] >= 0.7, y) for i, y in labels if i % 3 == 0]
    assert sum(p == bool(y) for p, y in held) / len(held) > 0.97


def test_a_feature_counts_once_and_order_matters(spark):
    weights = {int(v): 1.0 for v in toxicity.features(__import__("pyarrow").array(["a b"]), 22)[1]}
    docs = docs_frame(spark, [(1, "a b", "s"), (2, "A  b a b", "s"), (3, "b a", "s"), (4, "a", "s")])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, weights, keep=["doc_id"]).collect()}
    assert got[1] == got[2] > got[3] > got[4]


def test_the_sample_is_bounded(spark):
    rows, labels = corpus(300)
    train = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.fit(docs_frame(spark, rows), train, "toxic", sample_rows=0) == {}
    assert toxicity.fit(docs_frame(spark, rows), train, "toxic", sample_rows=200) != {}


def test_awkward_rows(spark):
    rows = messy()
    docs = docs_frame(spark, rows)
    odd = [(1, 1), (2, 1), (5, None), (6, 7), (None, 1), (99, 0), (7, 0), (7, 0), (4, 1)]
    weights = toxicity.fit(docs, spark.createDataFrame(odd, "doc_id long, toxic int"), "toxic")
    got = toxicity.score(docs, weights).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not (r["text"] or "").strip()}) == 1
    none = spark.createDataFrame([], DOCS)
    assert toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"), "toxic") == {}
    assert toxicity.score(none, {}).collect() == []


@pytest.mark.parametrize("modulus", (3, 7))
def test_folds(spark, modulus):
    ids = [0, 1, 17, 12345678901, None]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = [r[0] for r in df.select(toxicity.fold(F.col("i"), modulus)).collect()]
    assert got == [zlib.crc32(("" if i is None else str(i)).encode()) % modulus for i in ids]
