import os
import random

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from llm_util import CLASHES, DOCS, docs_frame, messy, words_of
from tools.check_oracles import compare, connect
from veilwork.llm import queries as llm_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """labels and benchmark for the stages, with nulls."""
    path = str(tmp_path_factory.mktemp("tables"))
    draw = random.Random(1)
    labels = [(i, 1, int(i % 5 == 0)) for i in range(300)] + [(None, None, None), (5, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    item = " ".join(f"bench{draw.randrange(10**6)}" for _ in range(15))
    spark.createDataFrame([(1, item), (2, None), (None, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def corpus(spark, folder):
    draw = random.Random(2)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("item_id = 1").first()["text"]
    rows = []
    for i in range(300):
        words = draw.choices([f"w{j}" for j in range(500)], k=draw.randrange(30, 80))
        if i % 5 == 0:
            words[draw.randrange(len(words))] = draw.choice(["vile", "scum"])
            words.append("scum")
        lines = ["Subscribe now"] * (i % 3 == 0) + [" ".join(words)]
        rows.append((i, "\n".join(lines), f"s{i % 4}"))
    rows += [(400 + i, rows[1 + i][1], "s9") for i in range(3)]  # copies
    rows += [(500, "intro words " + item + " more words", "s1")]
    return rows


def test_stages_take_effect(spark, folder):
    rows = corpus(spark, folder)
    docs = docs_frame(spark, rows, clashes=False)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "decontamination", "mixing"]

    clean = stages["toxicity"](spark, docs, folder)
    kept = {r["doc_id"] for r in clean.collect()}
    bad = {i for i, t, _ in rows if "scum" in t}
    assert clean.schema == docs.schema
    assert len(bad & kept) <= 0.05 * len(bad) and len({i for i, _, _ in rows} - bad - kept) <= 5

    lines = {r["doc_id"]: r for r in stages["line_dedup"](spark, docs, folder).collect()}
    assert len(lines) == len(rows)
    assert [i for i, r in lines.items() if "Subscribe" in r["text"]] == [0]
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())

    once = {r["doc_id"] for r in stages["near_copies"](spark, docs, folder).collect()}
    assert {i for i, _, _ in rows} - once == {400, 401, 402}

    assert {i for i, _, _ in rows} - {r["doc_id"] for r in stages["decontamination"](spark, docs, folder).collect()} == {500}

    mix = stages["mixing"](spark, docs, folder).collect()
    sizes = {i: len(words_of(t)) for i, t, _ in rows}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 < r["taken"] <= 3 * r["size"] for r in mix)


@pytest.mark.parametrize("stage", range(5))
def test_every_stage_takes_awkward_rows(spark, folder, stage):
    name, run = corpus_pipeline.STAGES[stage]
    rows = messy()
    docs = docs_frame(spark, rows)
    out = run(spark, docs, folder)
    if name != "mixing":
        assert out.columns == [c for c in docs.columns if name != "line_dedup" or c != "kept_lines"]
        assert len(out.collect()) == (len(rows) - 2 if name == "near_copies" else len(rows))
    else:
        assert set(CLASHES) - set(out.columns) == set()
        assert all(r["size"] == len(words_of(r["text"])) for r in out.collect())
    assert run(spark, spark.createDataFrame([], DOCS), folder).collect() == []


def test_run_on_the_given_tables(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r["taken"] > 0 for r in rows)


def test_queries_are_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(llm_queries.QUERIES) <= set(queries()) and "pipeline" in queries()


@pytest.mark.parametrize("name", ("op4_mix_sources", "op7_jaccard_join", "op9_line_dedup"))
def test_same_as_sql(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    outcome = compare(spark, connect(FOLDER), FOLDER, name, queries()[name], oracle_sql()[name])
    assert outcome.startswith("ok"), outcome
