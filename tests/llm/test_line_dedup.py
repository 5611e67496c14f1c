import random
from collections import defaultdict

import pytest

from llm_util import DOCS, LOW, docs_frame, messy
from veilwork.llm import line_dedup


def plain(rows, min_docs, keep_first):
    """Kept lines by (id, text), rows equal in both being one document."""
    where = defaultdict(list)
    for doc in set(rows):
        for pos, line in enumerate((doc[1] or "").split("\n")):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOW)
            if key:
                where[key].append((doc, pos))
    lost = {x for places in where.values() if len({d for d, _ in places}) >= min_docs for x in places}
    kept = {d: [x for i, x in enumerate((d[1] or "").split("\n")) if (d, i) not in lost] for d in set(rows)}
    return kept, where, lost


def run(spark, rows, **options):
    df = docs_frame(spark, [(i, t, "s") for i, t in rows])
    out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, **options))
    return [((r["doc_id"], r["text"]), r["kept_lines"]) for r in out.collect()]


@pytest.mark.parametrize("seed", range(2))
def test_frequent_lines_go(spark, seed):
    draw = random.Random(seed)
    pool = ["Same line", " same LINE\t", "b", "", "  ", "ünï", *(f"rare {i}" for i in range(40))]
    rows = [(i, "\n".join(draw.choices(pool, k=draw.randrange(1, 150)))) for i in range(30)]
    rows += [(None, "Same line\nb"), (31, None), (32, ""), rows[0], rows[0]]
    kept, _, _ = plain(rows, 10, False)
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert all(lines == kept[doc] for doc, lines in got)


def test_the_first_occurrence_can_stay(spark):
    rows = [(i, f"top\nown {i}\ntop") for i in range(12)] + [(None, "TOP")]
    got = dict(run(spark, rows, keep_first=True))
    assert got[(None, "TOP")] == ["TOP"]  # a null id sorts first
    assert all(got[(i, f"top\nown {i}\ntop")] == [f"own {i}"] for i in range(12))


def test_bitmaps_hold_only_words_that_lose_lines(spark):
    rows = [(i, "\n".join(f"{i} {j}" for j in range(100)) + "\ncommon") for i in range(10)]
    maps = line_dedup.keep_bitmaps(docs_frame(spark, [(i, t, "s") for i, t in rows])).collect()
    assert len(maps) == 10
    assert all(m["kept"] == {1: ~(1 << 36)} for m in maps)


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, _ in messy()]
    assert sorted(map(str, run(spark, rows))) == sorted(str((d, (d[1] or "").split("\n"))) for d in rows)
    none = spark.createDataFrame([], DOCS)
    assert line_dedup.apply_bitmaps(none, line_dedup.keep_bitmaps(none)).collect() == []


def test_no_python_in_the_plan(spark):
    df = docs_frame(spark, [(1, "a", "s")])
    text = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
