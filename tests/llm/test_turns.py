"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from veilwork.llm import turns
from veilwork.llm.queries import op11_conversation_repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLE = {"u": "user", "a": "assistant"}


def damaged(rows):
    """Plain damage of (conv, turn, role, text) rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = out[conv]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        kept += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def plain(rows):
    """What repair_conversations returns for one conversation's (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = WORD.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    dated = [r[0] for r in rows if r[0] is not None]
    gaps = max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0
    firsts = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, said = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        for c in "ua":
            if (state, c) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", i, c, (*said, ROLE[c] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, said))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if (state, role[:1]) in NEXT:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, NEXT[state, role[:1]], (*said, f"{role}:{text}")))
                for c in "ua":
                    if (state, c) in NEXT:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, c, (*said, f"{ROLE[c]}:{text}")))
    n = Counter(faults)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, "\n".join(said)


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]


def fixed(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in rows}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for _ in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ünder", "a"])
            text = rng.choice(["", " \t", "Yes.", "No", "Well?! ", "ok\n", None, " ", "More text. And more"])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 3, 7, -2]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_automaton_reads_the_role_grammar():
    a = turns.automaton()
    assert len(turns.known_stacks()) == 6
    for n in range(1 << 12):
        word = "".join("sua"[n // 3**k % 3] for k in range(7))
        for size in range(8):
            tops = {turns.BOTTOM}
            for c in word[:size]:
                tops = {x for top in tops for x in a.read(top, c)}
            assert any(map(a.accepts, tops)) == bool(re.fullmatch("(s?(ua)+)?", word[:size]))


def test_ambiguous_grammar_keeps_all_stacks():
    a = turns.Automaton((("E", "EE"), ("E", "x")))
    tops = {turns.BOTTOM}
    for _ in range(4):
        tops = {x for top in tops for x in a.read(top, "x")}
    assert any(map(a.accepts, tops)) and len(tops) > 1


def test_equal_stacks_keep_the_least_cost_and_audit():
    heads = {("x", None): (3, 1), ("y", None): (3, 0), ("z", None): (1, 2)}
    step = {"x": [("t", 2, "D")], "y": [("t", 2, "K"), ("u", 0, "ID")], "z": [("u", 2, "D")]}
    new, links = turns.extend(heads, lambda top: step[top[0]])
    assert {t: c for t, (c, _) in new.items()} == {"t": 5, "u": 3}
    assert links == {"t": (("y", None), "K"), "u": (("y", None), "ID")}


@pytest.mark.parametrize("seed", range(3))
def test_repairs_match_a_plain_search(spark, seed):
    rows = random_rows(seed, 300, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = {conv: plain(kept) for conv, kept in damaged(rows).items()}
    assert fixed(turns.repair_conversations(df, turns.damaged)) == wanted
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert fixed(turns.repair_conversations(df)) == {conv: plain(kept) for conv, kept in by_conv.items()}


def test_one_conversation_with_most_rows_is_cut_over_tasks(spark):
    rng = random.Random(5)
    rows = [(7, t // 2, rng.choice(["user", "assistant", "system"]), f"t{rng.randint(0, 900)}" + rng.choice(["", ".", "!"])) for t in range(4000)]
    rows += [(7, 5000, "user", "Same again.")] * 700 + [(c, t, "user" if t % 2 == 0 else "assistant", "Yes.") for c in (1, 9) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = turns.repair_conversations(df, turns.damaged).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in found} == {c: plain(k) for c, k in damaged(rows).items()}


def test_awkward_tables(spark):
    empty = turns.repair_conversations(spark.createDataFrame([], SCHEMA), turns.damaged)
    assert empty.collect() == [] and empty.columns == ["conv_id", *FIELDS]
    # Ids whose only turn is dropped, a null id, rows that repeat, a very long text, clashing columns.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Gone."), (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."),
            (2000, 0, "user", "long " * 200_000 + "."), (2000, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("conv", "copies", "fault", "audit", "_conv", "mark", "cost"):
        df = df.withColumn(c, df["role"])
    found = fixed(turns.repair_conversations(df, turns.damaged))
    assert found == {c: plain(k) for c, k in damaged(rows).items()}
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", "")


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = {}
    for conv, kept in damaged(rows).items():
        *counts, said = plain(kept)
        wanted[conv] = (*counts, hashlib.sha256(said.encode()).hexdigest())
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r["conv_id"]: tuple(r[c] for c in names) for r in op11_conversation_repair(spark, folder).collect()}
    assert found == wanted
