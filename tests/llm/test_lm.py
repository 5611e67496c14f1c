import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_util import DOCS, docs_frame, messy, words_of
from veilwork.llm import lm


def brute(rows, trained, order):
    """The same model by dictionaries, one text at a time."""
    counts = [Counter() for _ in range(order + 1)]
    starts = 0
    for (_, text, _), use in zip(rows, trained, strict=True):
        if use:
            seq = ["<s>", *words_of(text), "</s>"]
            starts += 1
            for k in range(1, order + 1):
                counts[k].update(tuple(seq[i - k + 1 : i + 1]) for i in range(max(1, k - 1), len(seq)))
    words, distinct = sum(counts[1].values()), len(counts[1])
    seen = {
        k: min(lm.SURE, 1 - sum(c == 1 for c in counts[k].values()) / sum(counts[k].values())) if counts[k] else 0.0
        for k in range(2, order + 1)
    }
    counts[1][("<s>",)] = starts
    out = []
    for _, text, _ in rows:
        seq = ["<s>", *words_of(text), "</s>"]
        base = score = 0.0
        for i in range(1, len(seq)):
            p = (counts[1][(seq[i],)] + 1) / (words + distinct + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                state = tuple(seq[i - k + 1 : i]) if i >= k - 1 else None
                if state and counts[k - 1][state]:
                    p = seen[k] * counts[k][(*state, seq[i])] / counts[k - 1][state] + (1 - seen[k]) * p
            score += math.log10(p)
        out.append((len(seq) - 1, sum(counts[1][(w,)] > 0 for w in seq[1:]), words, base, score))
    return out


@pytest.mark.parametrize(("order", "block"), [(1, 1 << 20), (2, 50), (3, 200)])
def test_same_as_brute_force(spark, monkeypatch, order, block):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "BUCKET_KEYS", 500)
    draw = random.Random(order)
    rows = [(i, " ".join(draw.choices("the The a b c dd e\nf é".split(" "), k=draw.randrange(0, 30))), "s") for i in range(80)]
    rows += [(100, "new words only here", "s"), (101, None, "s"), (102, "", "s")]
    want = brute(rows, [i % 4 != 0 for i, _, _ in rows], order)
    got = {r["doc_id"]: r for r in lm.score_texts(docs_frame(spark, rows), F.col("doc_id") % 4 != 0, order).collect()}
    for (i, _, _), w in zip(rows, want, strict=True):
        r = got[i]
        assert r["held_out"] == (i % 4 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["base_score"] == pytest.approx(w[3]) and r["score"] == pytest.approx(w[4])


def test_weights_of_a_state_sum_to_one(spark):
    """Over all words seen in training and one unknown word."""
    rows = [(i, t, "s") for i, t in enumerate(["a b a c", "b b", "a"])]
    probe = [(10 + i, f"a {w}", "s") for i, w in enumerate(["a", "b", "c", "zzz"])] + [(20, "a", "s")]
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(docs_frame(spark, rows + probe), F.col("doc_id") < 10).collect()}
    model = brute(rows + probe, [True] * 3 + [False] * 5, 2)
    assert got[20] == pytest.approx(model[-1][-1])
    counts = Counter(["a", "b", "a", "c", "</s>", "b", "b", "</s>", "a", "</s>"])
    after = Counter(["b", "c", "</s>"])
    bigrams = Counter([("<s>", "a"), ("a", "b"), ("b", "a"), ("a", "c"), ("c", "</s>"), ("<s>", "b"), ("b", "b"), ("b", "</s>"), ("<s>", "a"), ("a", "</s>")])
    seen = 1 - sum(c == 1 for c in bigrams.values()) / sum(bigrams.values())
    total = sum(seen * after[w] / 3 + (1 - seen) * (counts[w] + 1) / (10 + 4 + 1) for w in [*counts, "zzz"])
    assert total == pytest.approx(1.0)


def test_awkward_rows(spark):
    rows = messy()
    got = lm.score_texts(docs_frame(spark, rows), F.col("doc_id") > 2).collect()
    assert len(got) == len(rows) and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in got)
    assert sum(r["held_out"] for r in got) == 4  # a null condition holds a row out
    assert lm.score_texts(spark.createDataFrame([], DOCS), F.lit(True)).collect() == []
    alone = lm.score_texts(docs_frame(spark, rows), F.lit(False)).collect()
    assert {(r["train_tokens"], r["score"], r["n_known"]) for r in alone} == {(0, 0.0, 0)}
