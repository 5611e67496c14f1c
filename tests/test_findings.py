"""Keys found in the data, known persons in text, profiles that add up."""

import datetime as dt

from pyspark.sql import functions as F

from veilwork.operators import dependencies as D
from veilwork.operators.profile import merged_profile, profile_columns, profile_parts
from veilwork.plans import access, persons, profiles, silver
from veilwork.schemas import DOMAINS
from veilwork.sources.csv_drop import ingest


def test_keys_are_found_and_faults_counted(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    fact = spark.createDataFrame([(1, 1), (7, 1), (7, 2), (None, 2)], "k bigint, n int")
    tables = {("s", "dim"): dim, ("s", "fact"): fact, ("s", "none"): dim.limit(0)}
    got = D.check_constraints(
        tables, [("s", "dim", "k"), ("s", "none", "k")], [(("s", "fact", "k"), ("s", "dim", "k")), (("s", "none", "k"), ("s", "dim", "k"))]
    ).collect()
    assert sorted((r["table_name"], r["constraint_type"], r["violations"]) for r in got) == [
        ("dim", "PRIMARY KEY", 2), ("fact", "FOREIGN KEY", 1), ("none", "FOREIGN KEY", 0), ("none", "PRIMARY KEY", 0),
    ]


def test_inclusions_over_more_columns_than_one_number_holds(spark):
    wide = spark.range(30).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(70)])
    tables = {("s", "wide"): wide, ("s", "text"): spark.range(3).select(F.col("id").cast("string").alias("t"))}
    names = D.column_names(tables)
    found = D.inclusions(D.column_values(tables), len(names))
    got = {(names[r["column"]][2], names[r["within"]][2]) for r in found.collect()}
    sets = {f"c{i}": {x % (i + 1) for x in range(30)} for i in range(70)}
    assert got == {(a, b) for a in sets for b in sets if a != b and sets[a] <= sets[b]}


def test_known_values_are_found_whole_and_longest_first(spark):
    rows = spark.createDataFrame(
        [("Ann", "Roy", "a.b@x.org", "9876543210", None), ("Ann Roy", "Sen", "b@x.org", None, "AC-77\\E1"), ("J", None, None, "123", None)],
        "first_name string, last_name string, email string, phone string, account_number string",
    )
    values = persons.known_values([rows])
    assert {(r["kind"], r["value"]) for r in values.collect()} == {
        ("KNOWN_NAME", "ann roy"), ("KNOWN_NAME", "ann roy sen"), ("KNOWN_EMAIL", "a.b@x.org"), ("KNOWN_EMAIL", "b@x.org"),
        ("KNOWN_PHONE", "9876543210"), ("KNOWN_ACCOUNT", "ac-77\\e1"),
    }
    texts = [
        (1, "ANN  Roy\nSen met Ann Roy (not Ann Roys, Joann Roy); mail A.B@x.org."), (2, None), (3, ""), (4, "98765432101 9876543210 ac-77\\e1"),
        (4, "98765432101 9876543210 ac-77\\e1"), (None, "b@x.org"), (5, "nobody"),
    ]
    df = spark.createDataFrame(texts, "id int, body string")
    got = persons.known_spans(df, values, "body", ["id"]).collect()
    assert sorted((r["id"] or 0, [(s["kind"][6:], s["value"]) for s in r["spans"]]) for r in got) == [
        (0, [("EMAIL", "b@x.org")]), (1, [("NAME", "ANN  Roy\nSen"), ("NAME", "Ann Roy"), ("EMAIL", "A.B@x.org")]),
        (2, []), (3, []), (4, [("PHONE", "9876543210"), ("ACCOUNT", "ac-77\\e1")]), (4, [("PHONE", "9876543210"), ("ACCOUNT", "ac-77\\e1")]), (5, []),
    ]


def test_spans_have_one_kind_each(spark):
    text = "9876543210, 4111 1111 1111 1111, 4111 1111 1111 1112, 4111111111111112, 12345678, a@b.org MRN-A12345 1/2/2020"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(access.text_spans(F.col("t")).alias("s"))
    got = [[(x["kind"], x["value"]) for x in r["s"]] for r in df.collect()]
    assert got == [[
        ("PHONE", "9876543210"), ("CREDIT_CARD", "4111 1111 1111 1111"), ("BANK_ACCOUNT", "4111111111111112"), ("BANK_ACCOUNT", "12345678"),
        ("EMAIL", "a@b.org"), ("MEDICAL_RECORD", "MRN-A12345"), ("DATE", "1/2/2020"),
    ], [], []]


def test_profiles_of_parts_add_up(spark):
    df = spark.range(6000).select(
        (F.col("id") % 3).alias("part"), F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("long"),
        F.lit(None).cast("string").alias("none"), F.when(F.col("id") % 2 == 0, "a@b.org").alias("mail"),
    )
    got = {r["column_name"]: r for r in merged_profile(profile_parts(df, ["part"])).collect()}
    exact = {r["column_name"]: r for r in profile_columns(df.drop("part"), exact_unique=True).collect()}
    assert set(got) == set(exact)
    for c, want in exact.items():
        for f in want.asDict():
            if f == "unique_ratio":
                assert abs(got[c][f] - want[f]) <= 0.05 * want[f]
            elif isinstance(want[f], float):
                assert abs(got[c][f] - want[f]) < 1e-9
            else:
                assert got[c][f] == want[f]
    assert 23 <= got["long"]["median_length"] <= 27 and got["none"]["median_length"] is None


def test_only_new_loads_are_sketched(spark, store, tmp_path):
    head = "customer_id,account_number,account_type,balance\n"
    folder = tmp_path / "drop"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.csv").write_text(head + f"{i},A{i},S,1\n")
        ingest(store, str(folder))
        assert profiles.profile_loads(store, "banking").count() == 1
    assert profiles.profile_loads(store, "banking").count() == 0
    found = {r["column_name"]: r["records"] for r in profiles.bronze_profile(store, "banking").collect()}
    assert found == dict.fromkeys(DOMAINS["banking"].source_columns, 3)
    assert silver.process_domain(store, "banking", dt.date(2026, 1, 1))["bronze_rows"] == 3


def test_small_loads_are_packed_and_nothing_else_changes(spark, store, tmp_path):
    from veilwork.sources import compact

    head, folder = "customer_id,first_name,account_number,account_type,balance\n", tmp_path / "drop"
    folder.mkdir()

    def rows_of(df):
        return sorted(map(str, df.collect()))

    for i in range(8):
        (folder / f"{i}.csv").write_text(head + "".join(f"{10 * i + j},Ann,A{i},SAVINGS,1\n" for j in range(3 + i)))
        ingest(store, str(folder))
        if i == 3:
            assert silver.process_domain(store, "banking", dt.date(2026, 1, 1))["bronze_rows"] == 18
    before = rows_of(store.read_bronze("banking"))
    reader = store.read_bronze("banking")
    assert compact.files_read(store, "banking") == 8
    assert compact.pack_loads(store, "banking", target_bytes=1) == 0  # every load is large enough by itself
    assert compact.pack_loads(store, "banking") == 8 and compact.pack_loads(store, "banking") == 0
    assert rows_of(store.read_bronze("banking")) == before == rows_of(reader)
    assert compact.files_read(store, "banking") == 1
    with_load = store.read_bronze("banking", with_load=True)
    assert with_load.select("_load_id").distinct().count() == 8
    # Later loads, runs and a second packing go on from there.
    stats = silver.process_domain(store, "banking", dt.date(2026, 1, 1))
    assert (stats["bronze_rows"], stats["inserted"], stats["already_processed"]) == (52, 34, 18)
    (folder / "new.csv").write_text(head + "900,Bob,B,SAVINGS,1\n")
    ingest(store, str(folder))
    assert store.read_bronze("banking").count() == 53
    assert compact.pack_loads(store, "banking") == 0  # a single load has nothing to be packed with
    (folder / "more.csv").write_text(head + "901,Bob,B,SAVINGS,1\n")
    ingest(store, str(folder))
    assert compact.pack_loads(store, "banking") == 2 and store.read_bronze("banking").count() == 54
    # A packing that fails before its entry leaves nothing to see.
    store.read_bronze("banking").withColumn("_from_load", F.lit("x")).withColumn("_load_id", F.lit("pack-lost")).write.mode(
        "append"
    ).partitionBy("_load_id").parquet(store.path("bronze/banking"))
    assert store.read_bronze("banking").count() == 54


def test_types_decide_formats_as_their_text_would(spark):
    import random

    rng = random.Random(4)
    rows = [
        (
            rng.choice([None, 0, 7, -5, 12345, 98765, 9876543210, 5876543210, 12345678, -12345678, 4111111111111111, 10**17, 10**18, -(10**12)]),
            rng.choice([None, 0.0, -1.5, 1e20, 3.25, float("nan"), float("inf"), float("-inf"), 1e-9, 12345678.0]),
            rng.choice([None, dt.date(1990, 1, 2), dt.date(9999, 12, 31), dt.date(1, 1, 1)]),
            rng.choice([None, dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(2020, 1, 2, 3, 4, 5, 60)]),
            rng.choice([None, True, False]),
        )
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "i bigint, d double, a date, t timestamp, b boolean")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    for exact in (True, False):
        got = sorted(map(str, profile_columns(df, exact).collect()))
        assert got == sorted(map(str, profile_columns(text, exact).collect()))
