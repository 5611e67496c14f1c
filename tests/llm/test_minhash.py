"""Tensored MinHash against exact similarity of all pairs."""

import random

import numpy as np

from llm_util import docs_frame, messy, words_of

from veilwork.llm import minhash
from veilwork.llm.textbytes import mix


def plain(rows, words, percent):
    """{row number: (n, component)} by comparing all pairs."""
    sets = []
    for _, text, _ in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(s), (least.get(top(i)) if s else doc)) for i, ((doc, _, _), s) in enumerate(zip(rows, sets, strict=True))]


def check(spark, rows, words, percent):
    found = minhash.near_duplicates(docs_frame(spark, rows), words, percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    wanted = [(d, n, c, d == c) for d, n, c in plain(rows, words, percent)]
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(wanted, key=order)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_copies_edited_copies_and_clean_texts(spark):
    rng = random.Random(3)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 400))]
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0, 1, len(base) // 20, len(base) // 9]))), "a"))
    rng.shuffle(rows)
    check(spark, rows, 2, 80)
    check(spark, rows, 5, 80)


def test_chain_of_edits_is_one_group(spark):
    """Each text is near the next one only, so links run through the whole chain."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words), "a"))
        words[i * 5 % 300] = f"x{i}"
    check(spark, rows, 2, 80)


def test_awkward_rows(spark):
    check(spark, [(i, t, s) for i, t, s in messy(20_000) if i is not None], 2, 80)
    found = minhash.near_duplicates(docs_frame(spark, messy(100)), 2, 80).collect()
    assert len(found) == len(messy(100))
    alone = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [tuple(r) for r in minhash.near_duplicates(alone, 2).collect()] == [(None, 2, None, True)] * 2
    none = minhash.near_duplicates(alone.limit(0), 2)
    assert none.collect() == []


def test_least_similarity_counts_exactly(spark):
    """Sets of 4 and 5 shingles with 4 in common link at 80 %, one shingle less does not."""
    rows = [(1, "a b c d e", "s"), (2, "a b c d e f", "s"), (3, "p q r s t", "s"), (4, "p q r s t u v", "s"),
            (5, "one two", "s"), (6, "ONE\ttwo", "s"), (7, "one", "s")]
    check(spark, rows, 2, 80)


def test_tables_meet_as_often_as_computed():
    rng = np.random.default_rng(5)
    for same, share in ((800, 0.8), (400, 0.4)):
        found = 0
        for _ in range(300):
            items = mix(rng.integers(1, 2**62, 1000, dtype=np.uint64))
            extra = (1000 - same) // 2
            a, b = np.sort(items[: same + extra]), np.sort(np.concatenate([items[:same], items[same + extra :]]))
            keys = minhash.tensored(minhash.collected(minhash.minimum_hashes([a, b], 24), 3))
            assert keys.shape == (2, 28)
            found += bool((keys[0] == keys[1]).any())
        wanted = 1 - minhash.miss(share, 8)
        assert abs(found / 300 - wanted) < 4 * (wanted * (1 - wanted) / 300) ** 0.5 + 0.01
    assert minhash.miss(0.8) < 5e-5


def test_pairs_come_out_of_their_first_table():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 3, (60, 7)).astype(np.uint64)
    keys = minhash.tensored(values)
    left, right = np.triu_indices(7, 1)
    assert minhash.table_bits(7) == 5 and (keys & np.uint64(31) == np.arange(21, dtype=np.uint64)).all()
    for a in range(60):
        for b in range(a):
            agree = np.flatnonzero(values[a] == values[b])
            shared = np.flatnonzero(keys[a] == keys[b])
            assert [(left[t], right[t]) for t in shared] == [(i, j) for i in agree for j in agree if i < j]
