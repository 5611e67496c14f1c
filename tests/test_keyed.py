"""Keyed tables: joins that leave the stored side in place, runs, and what failed runs leave behind."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.plans import silver, star
from veilwork.schemas import DOMAINS
from veilwork.sources.csv_drop import ingest
from veilwork.sources.tables import RUN, Keyed, TableStore

AS_OF = dt.date(2026, 1, 1)
HEAD = "customer_id,first_name,account_number,account_type,balance,address\n"


def exchanged_scans(df):
    """For each scan of a keyed table in the plan: whether rows are exchanged above it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out, path = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*("))
        path = [(d, x) for d, x in path if d < depth] + [(depth, line)]
        if "Scan parquet spark_catalog.default.veilwork_" in line or "FileScan parquet spark_catalog.default.veilwork_" in line:
            out.append(any("Exchange" in x for _, x in path))
            assert out[-1] or "Bucketed: true" in line
    return out


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text(HEAD + "".join(rows))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("buckets", [3, 8, 32])
def test_stored_side_is_not_exchanged(spark, tmp_path, no_broadcast, buckets):
    store = TableStore(spark, str(tmp_path / "w"), buckets)
    places = ["Pune", "", "5 Park Street Kolkata"]
    drop(tmp_path / "d", "a", [f"{i},Ann,ACC{i},SAVINGS,1,{places[i % 3]}\n" for i in range(300)])
    ingest(store, str(tmp_path / "d"))
    silver.process_domain(store, "banking", AS_OF)
    star.load_star(store, "banking", 8)
    domain = DOMAINS["banking"]
    stored = store.keyed(silver.silver_table(domain))
    claims = spark.range(250, 400).select(F.col("id").alias("_claim")).groupBy("_claim").agg(F.min("_claim").alias("_bronze_id"))
    left = silver.unclaimed(claims, stored, domain, buckets)
    assert exchanged_scans(left) == [False] and left.count() == 100
    done = store.read(star.RUNS, star.RUNS_SCHEMA).limit(0)
    fresh = star.fresh_rows(store, domain, done, rescan=False)
    # Silver of the runs looked at is the batch; the fact is the stored side.
    assert exchanged_scans(fresh) == [True, False] and fresh.isEmpty()
    for spec in domain.dims:
        table = store.keyed(star.dim_table(domain, spec))
        known = star.known_members(table, stored.where("customer_id < 5"), spec, buckets)
        assert exchanged_scans(known)[0] is False
        assert known.columns == star.dim_schema(domain, spec).names
        assert known.count() == {"dim_customer": 5, "dim_account": 5, "dim_location": 3}[spec.name]


def test_keyed_table_keeps_its_layout_in_other_sessions(spark, tmp_path):
    table = Keyed("layer/t's table", T.StructType.fromDDL("k string, v int"), ("k",))
    store = TableStore(spark, str(tmp_path / "w"), 5)
    assert store.runs(table) == set() and store.keyed(table).columns == ["k", "v", RUN]
    rows = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], table.schema)
    store.append_keyed(table, rows, "one")
    other = TableStore(spark.newSession(), str(tmp_path / "w"), 9)
    other.append_keyed(table, rows.limit(0), "none")
    other.append_keyed(table, other.spark.createDataFrame([("b", 4)], table.schema), "two")
    assert other.buckets == 5 and other.runs(table) - {"none"} == store.runs(table) - {"none"} == {"one", "two"}
    assert sorted(r["v"] for r in store.keyed(table).collect()) == [1, 2, 3, 4]
    assert store.read(table.name, table.schema).columns == ["k", "v"]
    assert store.keyed(table).where(F.col(RUN) == "two").count() == 1


def test_runs_that_did_not_reach_the_log_are_compared_by_row(spark, tmp_path, monkeypatch):
    store, folder = TableStore(spark, str(tmp_path / "w"), 4), tmp_path / "d"
    drop(folder, "a", [f"{i},Ann,ACC{i},SAVINGS,1,Pune\n" for i in (1, 2, 2)] + ["3,,A,SAVINGS,1,Pune\n"])
    ingest(store, str(folder))
    real = TableStore.append

    def append(self, name, *args):
        if name in (silver.RUNS, star.RUNS):
            raise OSError("the log cannot be written")
        return real(self, name, *args)

    for job in (lambda: silver.process_domain(store, "banking", AS_OF), lambda: star.load_star(store, "banking", 8)):
        monkeypatch.setattr(TableStore, "append", append)
        with pytest.raises(OSError, match="log"):
            job()
        monkeypatch.setattr(TableStore, "append", real)
        again = job()
        assert set(again.values()) == {0} or (again["inserted"], again["already_processed"]) == (0, 2)
    drop(folder, "b", [f"{i},Bob,ACC{i},SAVINGS,1,Pune\n" for i in (2, 3, 4)])
    ingest(store, str(folder))
    stats = silver.process_domain(store, "banking", AS_OF)
    assert (stats["inserted"], stats["already_processed"], stats["bronze_rows"]) == (2, 2, 7)
    assert star.load_star(store, "banking", 8) == {"dim_customer": 2, "dim_account": 2, "dim_location": 0, "fact_account": 2}
    assert set(star.load_star(store, "banking", 8, rescan=True).values()) == {0}
    tables = star.star_tables(store, DOMAINS["banking"])
    keys = [r[0] for r in tables["dim_customer"].select("customer_key").collect()]
    assert len(keys) == len(set(keys)) == 4 and tables["fact_account"].count() == 4


def test_two_batches_give_what_one_gives(spark, tmp_path):
    rows = [f"{i % 70},{'Ann' if i % 7 else ''},ACC{i % 11},{['SAVINGS', 'CURRENT'][i % 2]},{i},{['Pune', '', 'Delhi'][i % 3]}\n" for i in range(200)]
    found = []
    for parts in ([rows], [rows[:90], rows[90:]]):
        store, folder = TableStore(spark, str(tmp_path / f"w{len(parts)}"), 4), tmp_path / f"d{len(parts)}"
        for i, part in enumerate(parts):
            drop(folder, f"p{i}", part)
            ingest(store, str(folder))
            silver.process_domain(store, "banking", AS_OF)
            star.load_star(store, "banking", 8)
        kept = store.read("silver/banking", DOMAINS["banking"].silver_schema).drop("_bronze_id")
        tables = star.star_tables(store, DOMAINS["banking"])
        people = tables["fact_account"].join(tables["dim_customer"], "customer_key").join(tables["dim_location"], "location_key")
        found.append([sorted(map(str, df.collect())) for df in (kept, people.select("customer_id", "balance", "address"))])
    assert found[0] == found[1] and len(found[0][0]) == 60


def test_epochs_settle_their_own_loads_and_repeats_add_nothing(spark, tmp_path, monkeypatch):
    from veilwork.streaming import ingest as stream

    store, folder = TableStore(spark, str(tmp_path / "w"), 4), tmp_path / "d"
    marks = str(tmp_path / "marks")

    def settled():
        kept = store.read("silver/banking", DOMAINS["banking"].silver_schema)
        return sorted((r["customer_id"], r["first_name"]) for r in kept.collect())

    drop(folder, "a", [f"{i},Ann,ACC{i},SAVINGS,1,Pune\n" for i in (1, 2, 2)])
    ingest(store, str(folder))
    stream.stream_silver(store, None, AS_OF, marks).awaitTermination()
    drop(folder, "b", [f"{i},Bob,ACC{i},SAVINGS,1,Pune\n" for i in (2, 3)])
    ingest(store, str(folder))
    # The second epoch writes its rows and fails before the log; the stream repeats it.
    real = TableStore.append

    def append(self, name, *args):
        if name == silver.RUNS:
            raise OSError("the log cannot be written")
        return real(self, name, *args)

    monkeypatch.setattr(TableStore, "append", append)
    with pytest.raises(Exception, match="log cannot be written"):
        stream.stream_silver(store, None, AS_OF, marks).awaitTermination()
    monkeypatch.setattr(TableStore, "append", real)
    assert settled() == [(1, "Ann"), (2, "Ann"), (3, "Bob")]
    stream.stream_silver(store, None, AS_OF, marks).awaitTermination()
    assert settled() == [(1, "Ann"), (2, "Ann"), (3, "Bob")]
    runs = store.read(silver.RUNS, silver.RUNS_SCHEMA).collect()
    assert sorted((r["inserted"], r["duplicate_primary_key"]) for r in runs) == [(1, 1), (2, 1)]
    assert {r["run_id"] for r in runs} == store.runs(silver.silver_table(DOMAINS["banking"]))
    # A batch run, a finished epoch and another stream find nothing open.
    assert silver.process_domain(store, "banking", AS_OF)["inserted"] == 0
    for run in {r["run_id"] for r in runs}:
        assert stream.settle_epoch(store, DOMAINS["banking"], AS_OF, store.manifest(), run) == 0
    stream.stream_silver(store, "banking", AS_OF, marks + "2").awaitTermination()
    assert len(settled()) == 3


def test_counts_come_from_footers(spark, tmp_path):
    from veilwork.sources import footers

    store = TableStore(spark, str(tmp_path / "w"), 3)
    table = Keyed("t", T.StructType.fromDDL("k bigint, `odd name` string, d date"), ("k",))
    rows = spark.range(50).select(
        F.col("id").alias("k"), F.when(F.col("id") % 5 == 0, "x").alias("odd name"), F.lit(None).cast("date").alias("d")
    )
    for run in ("a", "b"):
        store.append_keyed(table, rows, run)
    found = footers.stored_counts(store, {"t": table.schema, "none": T.StructType.fromDDL("v int")}).collect()
    assert sorted(map(tuple, found)) == [("none", "v", 0, 0), ("t", "d", 100, 0), ("t", "k", 100, 100), ("t", "odd name", 100, 20)]
    plan = footers.footer_counts(footers.counting_session(spark), store.path("t"), table.schema)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
