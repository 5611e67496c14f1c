import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from veilwork.operators import evaluate as E
from veilwork.operators.checks import require_columns
from veilwork.operators.dedupe import duplicate_groups, first_per_key
from veilwork.operators.joins import with_lookup
from veilwork.operators.keys import stable_hash, with_surrogate_keys
from veilwork.operators.profile import column_counts, column_samples, profile_columns
from veilwork.operators.ranks import stratified_split


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_surrogate_keys_are_unique_stable_and_above_base(spark):
    names = spark.range(3000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("name"))
    one = with_surrogate_keys(names, ("name",), "k", base=100, buckets=16)
    two = with_surrogate_keys(names.repartition(7).orderBy(F.desc("name")), ("name",), "k", base=100, buckets=16)
    a, b = ({r["name"]: r["k"] for r in df.collect()} for df in (one, two))
    assert a == b and len(set(a.values())) == 3000 and min(a.values()) > 100


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    rows = spark.range(0, 20000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    first = first_per_key(rows, ["k"], ["id"])
    text = plan(first)
    assert text.count("WindowGroupLimit") >= 2
    got = {r["k"]: r["id"] for r in first.collect()}
    assert got[0] == 0 and len(got) == 20000 - 6667 + 1


def test_split_matches_brute_force_with_a_hot_class(spark):
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 else rng.choice("abc")) for i in range(2000)]
    df = spark.createDataFrame(data, "id bigint, label string")
    order = stable_hash(F.col("id"))
    marked = stratified_split(df, "label", order, "id").withColumn("h", order).collect()
    for label in {d[1] for d in data}:
        rows = sorted((r["h"], r["id"], r["is_test"]) for r in marked if r["label"] == label)
        n = -(-len(rows) // 5)
        assert [r[2] for r in rows] == [True] * n + [False] * (len(rows) - n)


def test_samples_match_brute_force_with_copies(spark):
    rng = random.Random(2)
    rows = [(1, None, "copy")] * 3000 + [(rng.randrange(50), rng.choice([None, "x", " y "]), str(i)) for i in range(3000)]
    rows.append((7, None, "z"))
    df = spark.createDataFrame(rows, "a int, b string, c string").withColumn("only", F.when(F.col("c") == "z", "one"))
    got = {r["column_name"]: r["samples"] for r in column_samples(df).collect()}
    from veilwork.operators.profile import default_row_hash

    hashed = df.withColumn("h", default_row_hash(df)).collect()
    for c in df.columns:
        want = sorted((r["h"], str(r[c])) for r in hashed if r[c] is not None)[:5]
        assert got[c] == [v.strip() for _, v in want], c
    counts = {r["column_name"]: (r["records_scanned"], r["non_null_records"]) for r in column_counts(df).collect()}
    assert counts["a"] == (6001, 6001) and counts["only"] == (6001, 1)


def test_exact_and_approximate_profiles_agree(spark):
    df = spark.createDataFrame(
        [("a@b.co", "12345678", None), ("A@b.co", " 9876543210 ", ""), ("x", "1 2", " ")], "e string, n string, z string"
    )
    exact, approx = (
        {r["column_name"]: r.asDict() for r in profile_columns(df, flag).collect()} for flag in (True, False)
    )
    for name in exact:
        assert exact[name] == pytest.approx(approx[name])
    assert exact["e"]["email_match_ratio"] == pytest.approx(2 / 3) and exact["e"]["unique_ratio"] == pytest.approx(2 / 3)
    assert exact["n"]["phone_match_ratio"] == pytest.approx(1 / 3) and exact["z"]["null_ratio"] == 1.0
    assert exact["z"]["avg_length"] == 0.0


def test_skewed_lookup_is_split(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).cast("string").alias("place"))
        places = spark.range(500).select(F.col("id").cast("string").alias("place"), F.col("id").alias("key"))
        places = places.unionByName(spark.createDataFrame([(None, -1)], "place string, key bigint"))
        joined = with_lookup(rows, places, "key", ["place"], null_safe=True)
        assert joined.where("key = -1").count() == 20000
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString().lower()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_duplicate_groups_ignore_case_and_edges(spark):
    df = spark.createDataFrame([(1, "A ", 1.0), (2, "a", 1.0), (3, "b", 1.0)], "id bigint, t string, d double")
    assert [(r["copies"], r["first_id"]) for r in duplicate_groups(df, ("t", "d"), "id").collect()] == [(2, 1)]


def test_metrics_against_hand_counts(spark):
    rows = [("a", "a", 0.9), ("a", "b", 0.8), ("b", "b", 0.7), ("c", "b", 0.6)]
    df = spark.createDataFrame(rows, "label string, predicted string, confidence double")
    report = {r["label"]: r for r in E.class_report(df).collect()}
    assert report["b"]["precision"] == pytest.approx(1 / 3) and report["b"]["recall"] == 1.0
    assert report["c"]["f1"] == 0.0 and report["a"]["support"] == 2
    total = E.overall_metrics(df).first()
    assert total["accuracy"] == 0.5 and total["avg_confidence"] == pytest.approx(0.75)
    assert total["precision"] == pytest.approx((2 * 1 + 1 / 3) / 4)
    matrix = [tuple(r) for r in E.confusion_matrix(df, ["a", "b", "c"]).collect()]
    assert matrix == [("a", 1, 1, 0), ("b", 0, 1, 0), ("c", 0, 1, 0)]
    weights = {r["label"]: r["weight"] for r in E.class_weights(df).collect()}
    assert weights == pytest.approx({"a": 4 / 6, "b": 4 / 3, "c": 4 / 3})
    assert [r["correct"] for r in E.mistakes_first(df).collect()] == [False, False, True, True]
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, ["nope"])


def test_one_bad_column_fails_alone(spark, store):
    import datetime as dt

    from veilwork.plans import gold, rules

    good = spark.range(20).select("id", F.lit("a@b.org").alias("email"), F.lit("x").alias("note"))
    broken = F.when(F.col("id") >= 0, F.raise_error(F.lit("cannot be read"))).cast("string").alias("bad")
    tables = {("s", "fact_one"): good, ("s", "dim_two"): good.select("email", broken, "note"), ("s", "empty"): good.limit(0)}
    done = gold.run_scan(store, tables, [], rules.classify_by_rules, dt.datetime(2026, 1, 1), "r", "s1")
    assert {r["status"]: r["columns"] for r in done.collect()} == {"successful": 8, "failed": 1}
    faults = store.read(gold.FAULTS, gold.FAULTS_SCHEMA).collect()
    assert [(r["table_name"], r["column_name"], "cannot be read" in r["error"]) for r in faults] == [("dim_two", "bad", True)]
    assert gold.read_gold(store)["fact_pii_scan"].count() == 8


def test_samples_are_cut_and_long_tables_merge_parts(spark):
    from veilwork.operators import profile

    df = spark.range(5000).repartition(7).select("id", F.lit("y" * 3000).alias("long"), F.when(F.col("id") > 4996, F.col("id")).alias("rare"))
    samples = {r["column_name"]: r["samples"] for r in column_samples(df, row_hash=F.col("id")).collect()}
    assert samples == {"id": list("01234"), "long": ["y" * profile.SAMPLE_WIDTH] * 5, "rare": ["4997", "4998", "4999"]}
    assert {r["column_name"]: r["samples"] for r in column_samples(df.limit(0)).collect()} == {"id": [], "long": [], "rare": []}
    parts = profile.column_parts(df, row_hash=F.col("id"))
    assert parts.agg(F.max(F.size("entries"))).first()[0] == 5
    merged = {r["column_name"]: (r["records_scanned"], r["non_null_records"]) for r in profile.merged_parts(parts, ["column_name"]).collect()}
    assert merged == {"id": (5000, 5000), "long": (5000, 5000), "rare": (5000, 3)}
