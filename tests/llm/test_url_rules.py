import itertools
import random

import pytest
from pyspark.sql import functions as F

from veilwork.llm import url_rules


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    return rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path[
        : min([path.find(c) for c in "?#" if c in path], default=len(path))
    ]


def longest(host, path):
    fits = [
        (len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme/x", "http://", "https://WWW.Example.COM/en/1", "http://example.com/en", "http://a.example.com/en/x?y=/es/",
    "x://net/es/", "http://notnet/es/", "http://b.net/es/#f", "http://b.net?/es/", "http://COM/", "http://com", "http://a.com#/en/",
    "http://www.example.com/en/a/b", "http://xwww.example.com/en/a", "http://é.net/fr/1?a=b", "a://b://c.net/fr/", "http://a.net/ES/",
    "http://h.org\n/x/y", "http://k.net:80/fr/", "http://.net/fr/", "http://" + "a." * 300 + "com/" + "p/" * 5000,
]


def test_hosts_paths_and_listed_rules(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[4]), (None, URLS[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("tokens", F.lit(1)).withColumn("label", F.lit("x"))
    got = url_rules.judge_urls(pages).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    for i, url in enumerate(URLS):
        host, path = split_url(url)
        rule, verdict = longest(host, path)
        r = next(x for x in by[i] if (x["host"], x["path"]) == (host, path))
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict), (url, r)
        assert r["verdict"] in ("allow", "block")


def test_no_rows_no_rules_no_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge_urls(none).collect() == []
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_rules.judge_urls(pages, rules=()).collect()} == {"allow"}


@pytest.mark.parametrize("seed", range(2))
def test_mined_rules_are_all_frequent_sure_and_minimal(spark, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(120):
        t = sorted(draw.sample("abcdef", draw.randrange(0, 5)))
        rows.append((t, "block" if "a" in t and "b" in t or draw.random() < 0.1 else draw.choice(["allow", "allow", None])))
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    known = [(set(t), y) for t, y in rows if y and t]
    want = {}
    for size in range(1, 7):
        for c in itertools.combinations("abcdef", size):
            for y in ("allow", "block"):
                both = sum(set(c) <= t and y == z for t, z in known)
                any_ = sum(set(c) <= t for t, _ in known)
                if both and both >= 0.02 * len(known) and both / any_ >= 0.6:
                    want[c, y] = both / any_
    want = {
        k: v for k, v in want.items()
        if not any(set(c) < set(k[0]) and y == k[1] and w >= v for (c, y), w in want.items())
    }
    rules = url_rules.mine_rules(df, 0.02, 0.6)
    got = {(tuple(r["antecedent"]), r["label"]): r["confidence"] for r in rules.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    found = {tuple(r["tokens"]): r["mined"]["confidence"] for r in url_rules.match_rules(df, rules).collect()}
    for t in {tuple(t) for t, _ in rows}:
        best = max([v for (c, _), v in want.items() if set(c) <= set(t)], default=None)
        assert found.get(t) == pytest.approx(best) if best else t not in found


def test_tokens_that_always_come_together_are_mined_as_one(spark):
    """Fifteen keys in the same URLs: as many rules, not 2^15; the rules are those of all frequent sets."""
    keys = "&".join(f"k{c}=1" for c in "abcdefghijklmno")
    rows = [(f"http://s{i % 3}.org/x?{keys}", "block") for i in range(60)] + [(f"http://s{i % 3}.org/y", "allow") for i in range(540)]
    df = spark.createDataFrame(rows, "url string, label string").select(url_rules.tokens(F.col("url")).alias("tokens"), "label")
    rules = url_rules.mine_rules(df).collect()
    block = {tuple(r["antecedent"]) for r in rules if r["label"] == "block"}
    assert block == {("folder:x",), *[(f"key:k{c}",) for c in "abcdefghijklmno"]}
    assert {tuple(r["antecedent"]) for r in rules if r["label"] == "allow"} >= {("folder:y",)}
    assert all(r["confidence"] == 1.0 for r in rules if r["label"] == "block")


def test_rules_are_those_of_a_plain_search(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        have = [t for t in "abcdef" if rng.random() < 0.4]
        have += ["x", "y"] if "a" in have else []  # always together, and with a
        rows.append((sorted(have), rng.choice(["l1", "l2"]) if "b" not in have else "l1"))
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(tuple(r["antecedent"]), r["label"]): (round(r["confidence"], 9), round(r["support"], 9)) for r in url_rules.mine_rules(df, 0.02, 0.6).collect()}
    used = [(set(t), label) for t, label in rows if t]
    found = {}
    for n in range(1, 9):
        for part in itertools.combinations("abcdefxy", n):
            inside = [label for t, label in used if set(part) <= t]
            for label in ("l1", "l2"):
                hits = inside.count(label)
                if hits and hits / len(used) >= 0.02 and hits / len(inside) >= 0.6:
                    found[part, label] = (hits / len(inside), hits / len(used))
    least = {
        (p, label): (round(c, 9), round(s, 9)) for (p, label), (c, s) in found.items()
        if not any(m == label and set(q) < set(p) and c2 >= c for (q, m), (c2, _) in found.items())
    }
    assert got == least
