import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm_util import DOCS, docs_frame, messy, words_of
from veilwork.llm import mixing


def highest_quotients(shares, seats):
    quota = Counter()
    for _ in range(seats):
        best = max(sorted(shares), key=lambda k: Fraction(shares[k]) / (2 * quota[k] + 1))
        quota[best] += 1
    return {k: quota[k] for k in shares}


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_those_of_the_highest_quotients(spark, seed):
    draw = random.Random(seed)
    groups = {g: {k: draw.choice([0, 1, 3, draw.randrange(1, 5000)]) for k in range(draw.randrange(1, 30))} for g in range(4)}
    seats = {g: draw.randrange(0, 200) if sum(p.values()) else 0 for g, p in groups.items()}
    rows = [(g, k, s, seats[g]) for g, p in groups.items() for k, s in p.items()]
    df = spark.createDataFrame(rows, "g int, k int, s long, seats long")
    got = mixing.apportion(df, ["g"], F.col("k"), F.col("s"), F.col("seats")).collect()
    for g, parties in groups.items():
        assert {r["k"]: r["quota"] for r in got if r["g"] == g} == highest_quotients(parties, seats[g])


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        out = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if out[s] > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return {**fixed, **out}
        fixed |= {s: most * sizes[s] for s in over}


def test_targets_and_words_taken(spark):
    draw = random.Random(5)
    texts = [(i, " ".join(["w"] * draw.randrange(0, 60)), draw.choice(["a", "a", "a", "b", "c", "Z", "é", None])) for i in range(400)]
    texts += [(1000, "only a few words", "tiny")]
    got = mixing.mix_sources(docs_frame(spark, texts), shard_tokens=500).collect()
    assert len(got) == len(texts)
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, s in texts:
        sizes[s] += len(words_of(t))
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
    for s, want in targets(sizes).items():
        assert {round(r["target"], 6) for r in got if r["source"] == s} == {round(want, 6)}
        shards = -(-sizes[s] // 500)
        assert abs(taken[s] - want) <= 16 * (shards + 1)


def test_reruns_agree_whatever_the_partitions(spark):
    texts = [(i, "a b c " * (i % 7), "s" + str(i % 3)) for i in range(200)]
    runs = [
        sorted(map(tuple, mixing.mix_sources(docs_frame(spark, texts).repartition(n)).collect())) for n in (1, 7)
    ]
    assert runs[0] == runs[1]


def test_awkward_rows(spark):
    rows = messy()
    got = mixing.mix_sources(docs_frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted((i or 0, len(words_of(t))) for i, t, _ in rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    empty = mixing.mix_sources(docs_frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["target"], r["taken"]) for r in empty] == [(0.0, 0)] * 2
