"""Files through Bronze, Silver, star schemas and the Gold scan."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from veilwork.plans import access, gold, reports, rules, silver, star
from veilwork.schemas import DOMAINS, star_constraints
from veilwork.sources.csv_drop import ingest
from veilwork.sources.tables import MANIFEST, MANIFEST_SCHEMA
from veilwork.streaming.ingest import stream_bronze, stream_silver

AS_OF = dt.date(2026, 1, 1)

BANKING = """Customer ID,First Name,last-name,EMAIL,phone,date_of_birth,account_number,account_type,balance,address,index,extra
1, Ann ,Roy,A@X.org,9876543210,01/02/1990,ACC100,SAVINGS,"1,000.50","1 MG Road, Pune",0,z
2,,Roy,b@x.org,9876543211,01/02/1990,ACC101,CURRENT,10,Pune,1,z
x,Bob,Roy,c@x.org,9876543212,01/02/1990,ACC102,CURRENT,10,Pune,2,z
1,Later,Roy,d@x.org,9876543213,01/02/1990,ACC103,CURRENT,10,Pune,3,z
3,Cyd,Roy,bad,123,31/02/1998,ACC104,VIP,abc,
2,Dee,Roy,e@x.org,9876543214,2099-01-01,ACC105,SALARY,-5,"Flat 1
Lane ""Q"", Delhi",5,z
"""
MEDICAL = """patient_id,first_name,last_name,email,phone,date_of_birth,address,blood_group,diagnosis,doctor_name,admission_date,medical_record_number
1,Ann,Roy,,,01/01/2000,,a+,Flu,Dr. Sen,01/01/1999,MRN1
2,Bob,Roy,,,01/01/2100,Mumbai,Z+,???,12345,05/05/2020,MRN2
"""


def drop_files(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as out:
            out.write(text)


def summary(df):
    return df.first().asDict()


def test_chain_and_reruns(spark, store, tmp_path):
    folder = str(tmp_path / "drop")
    drop_files(folder, bank=BANKING, med=MEDICAL, odd="a,b\n1,2\n", twice="a b,a-b\n1,2\n")
    first = summary(ingest(store, folder))
    assert first == {"files_found": 4, "files_ingested": 2, "files_skipped": 0, "files_failed": 2, "rows_ingested": 8}
    raw = store.read_bronze("banking").orderBy("_bronze_id").collect()
    assert [r["customer_id"] for r in raw] == ["1", "2", "x", "1", "3", "2"]
    assert raw[0]["first_name"] == " Ann " and raw[4]["address"] == ""
    assert raw[5]["address"] == 'Flat 1\nLane "Q", Delhi' and raw[0]["_source_file"] == "bank.csv"
    assert "extra" not in raw[0].asDict()
    again = summary(ingest(store, folder))
    assert (again["files_skipped"], again["files_failed"], again["rows_ingested"]) == (2, 2, 0)

    stats = {r["domain"]: r.asDict() for r in silver.process_all(store, AS_OF).collect()}
    assert stats["banking"] == {
        "domain": "banking", "bronze_rows": 6, "already_processed": 0, "inserted": 3, "rejected": 3,
        "invalid_primary_key": 1, "missing_first_name": 1, "duplicate_primary_key": 1, "exact_duplicate": 0,
    }
    assert stats["TOTAL"]["bronze_rows"] == 8 and stats["TOTAL"]["inserted"] == 5
    bank = {r["customer_id"]: r for r in store.read("silver/banking", DOMAINS["banking"].silver_schema).collect()}
    assert bank[1]["first_name"] == "Ann" and bank[1]["balance"] == 1000.5 and bank[1]["city"] == "Pune"
    # The nameless row did not claim key 2.
    assert bank[2]["first_name"] == "Dee" and bank[2]["date_of_birth"] is None and bank[2]["balance"] == -5
    assert [bank[3][c] for c in ("email", "phone", "date_of_birth", "account_type", "balance", "address")] == [None] * 6
    med = {r["patient_id"]: r for r in store.read("silver/medical", DOMAINS["medical"].silver_schema).collect()}
    assert med[1]["admission_date"] is None  # before birth
    assert med[2]["date_of_birth"] is None and med[2]["admission_date"] == dt.date(2020, 5, 5)

    for rescan in (False, True):
        rerun = {r["domain"]: r.asDict() for r in silver.process_all(store, AS_OF, rescan).collect()}["banking"]
        assert (rerun["already_processed"], rerun["inserted"], rerun["rejected"]) == (3, 0, 3)

    added = star.load_all_stars(store)
    assert added["banking"] == {"dim_customer": 3, "dim_account": 3, "dim_location": 3, "fact_account": 3}
    assert added["medical"]["fact_admission"] == 2 and added["medical"]["dim_doctor"] == 1
    fact = star.star_tables(store, DOMAINS["banking"])["fact_account"]
    # A missing address has a location member of its own.
    assert fact.where("location_key IS NULL").isEmpty()
    assert all(n == 0 for t in star.load_all_stars(store).values() for n in t.values())

    # Known number with a new type: no new member, and no account for the fact row.
    drop_files(folder, bank2=BANKING.splitlines()[0] + "\n9,Eve,Roy,,,,ACC100,SALARY,1,Pune,0,z\n")
    ingest(store, folder)
    silver.process_domain(store, "banking", AS_OF)
    more = star.load_star(store, "banking")
    assert more == {"dim_customer": 1, "dim_account": 0, "dim_location": 1, "fact_account": 1}
    tables = star.star_tables(store, DOMAINS["banking"])
    assert tables["fact_account"].where("account_key IS NULL").count() == 1
    keys = [r[0] for r in tables["dim_customer"].select("customer_key").collect()]
    assert len(set(keys)) == 4

    # Gold
    warehouse = {("star_banking", n): df for n, df in tables.items()}
    at = dt.datetime(2026, 1, 1, 9)
    for i in (1, 2):
        when = at + dt.timedelta(days=i)
        done = gold.run_scan(store, warehouse, star_constraints(), rules.classify_by_rules, when, "r1", f"s{i}")
        assert {r["status"]: r["columns"] for r in done.collect()} == {"successful": 19, "failed": 0}
    dims = gold.read_gold(store)
    assert {n: df.count() for n, df in dims.items()} == {
        "dim_source_schema": 1, "dim_table": 4, "dim_column": 19, "dim_pii_type": 13, "dim_sensitivity": 3,
        "dim_date": 5844, "fact_pii_scan": 38,
    }
    newest = gold.latest_scan(dims["fact_pii_scan"])
    assert newest.count() == 19 and newest.select("scan_id").distinct().collect()[0][0] == "s2"
    catalog = reports.pii_catalog(newest, dims)
    kinds = {(r["table_name"], r["column_name"]): r["pii_type"] for r in catalog.collect()}
    assert kinds["dim_customer", "email"] == "EMAIL" and kinds["dim_customer", "phone"] == "PHONE"
    assert kinds["dim_account", "account_type"] == "NON_PII" and kinds["fact_account", "balance"] == "FINANCIAL_INFORMATION"
    stranger = spark.createDataFrame([("star_banking", "t", "c", "EMAIL")], "schema_name string, table_name string, column_name string, pii_type string")
    with pytest.raises(Exception, match="no table_key"):
        gold.resolve_keys(stranger, dims).collect()
    with pytest.raises(Exception, match="no sensitivity policy"):
        gold.with_sensitivity(stranger.withColumn("pii_type", F.lit("ODD"))).collect()


def test_rows_of_unfinished_loads_stay_invisible(spark, store, tmp_path):
    folder = str(tmp_path / "drop")
    drop_files(folder, bank=BANKING)
    ingest(store, folder)
    rows = store.read_bronze("banking")
    rows.withColumn("_load_id", F.lit("crashed")).write.mode("append").partitionBy("_load_id").parquet(store.path("bronze/banking"))
    assert store.read_bronze("banking").count() == 6


def test_ids_are_unique_and_ordered_over_many_splits(spark, store, tmp_path):
    folder = str(tmp_path / "drop")
    head = "customer_id,first_name,campaign_name,campaign_date,channel\n"
    drop_files(
        folder,
        a=head + "".join(f"{i},Ann,c,01/01/2020,SMS\n" for i in range(5000)),
        b=head + "".join(f"{i},Bob,c,01/01/2020,SMS\n" for i in range(5000, 5400)),
        c=head + "".join(f"{i},Cyd,c,01/01/2020,SMS\n" for i in range(5400, 9000)),
    )
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        ingest(store, folder)
        rows = store.read_bronze("marketing").orderBy("_bronze_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [int(r["customer_id"]) for r in rows] == list(range(9000))
    assert len({r["_bronze_id"] for r in rows}) == 9000 and rows[0]["email"] is None


def test_streams_equal_batch_and_repeat_nothing(spark, store, tmp_path):
    folder = str(tmp_path / "drop")
    drop_files(folder, one=BANKING)
    marks = str(tmp_path / "marks")
    for round_ in range(3):
        stream_bronze(store, folder, marks + "/b").awaitTermination()
        stream_silver(store, "banking", AS_OF, marks + "/s").awaitTermination()
        if round_ == 0:
            assert store.read("silver/banking", DOMAINS["banking"].silver_schema).count() == 3
            drop_files(folder, two=BANKING.splitlines()[0] + "\n7,Eve,Roy,,,,ACC100,SALARY,1,Pune,0,z\n1,X,,,,,,,,,,\n")
    rows = store.read("silver/banking", DOMAINS["banking"].silver_schema).collect()
    assert sorted(r["customer_id"] for r in rows) == [1, 2, 3, 7]
    raw = store.read_bronze("banking").collect()
    assert len(raw) == 8 and len({r["_bronze_id"] for r in raw}) == 8
    assert 'Flat 1\nLane "Q", Delhi' in {r["address"] for r in raw}


def test_stream_sees_folders_headers_domains_and_earlier_loads(spark, store, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    drop_files(first, bank=BANKING)
    summary(ingest(store, first))
    turned = "first_name,account_type,customer_id,account_number,balance\nAnn,SAVINGS,11,ACC1,5\n"
    drop_files(second, turned=turned, med=MEDICAL, **{"odd[1]{x}": turned.replace("11", "12"), "bad": "a,b\n1,2\n"})
    for i, folder in enumerate((first, second, second)):
        stream_bronze(store, folder, str(tmp_path / f"marks{i}")).awaitTermination()
    raw = store.read_bronze("banking").collect()
    assert len(raw) == 8 and store.read_bronze("medical").count() == 2
    assert {r["customer_id"]: r["first_name"] for r in raw if r["_source_file"] != "bank.csv"} == {"11": "Ann", "12": "Ann"}
    assert store.manifest().count() == 4


def test_one_unreadable_file_does_not_stop_its_group(spark, store, tmp_path):
    folder = str(tmp_path / "drop")
    drop_files(folder, **{f"f{i}": f"customer_id,account_number,account_type,balance\n{i},A,S,1\n" for i in range(5)})
    import veilwork.sources.csv_drop as drop

    real = drop.read_raw

    def read_raw(spark, group):
        if any(f.name == "f3.csv" for f in group.files):
            raise OSError("cannot be read")
        return real(spark, group)

    drop.read_raw = read_raw
    try:
        done = summary(ingest(store, folder))
    finally:
        drop.read_raw = real
    assert (done["files_ingested"], done["files_failed"], done["rows_ingested"]) == (4, 1, 4)


def test_role_views(spark):
    df = spark.createDataFrame([("a@b.org", 5, "x")], "email string, n int, unknown string")
    types = {"email": "EMAIL", "n": "NON_PII"}
    assert access.secure_view(df, types, access.ADMINISTRATOR, "k").first() == df.first()
    assert tuple(access.secure_view(df, types, access.ANALYST, "k").first()) == ("a****@b.org", 5, "[REDACTED]")
    with pytest.raises(access.AccessDenied):
        access.secure_view(df, types, "Visitor", "k")


def test_free_text(spark):
    text = "mail a.b@c.org or +91 9876543210, born 01/02/1990, card 4111 1111 1111 1111, MRN-12345 acct 123456789"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert df.select(access.redact_text(F.col("t"))).first()[0] == (
        "mail [EMAIL] or [PHONE], born [DATE], card [CREDIT_CARD], [MEDICAL_RECORD] acct [BANK_ACCOUNT]"
    )


def test_bronze_rows_of_one_load_stay_spread(spark, store):
    spec = DOMAINS["banking"]
    texts = [F.lit("x").alias(c) for c in spec.source_columns]
    rows = spark.range(80_000).repartition(8).select(F.col("id").alias("_bronze_id"), *texts, F.lit("one").alias("_load_id"))
    store.append("bronze/banking", rows, ("_load_id",))
    entry = spark.createDataFrame([(1, "f", "s", "banking", "b", None, "one", 80_000, 80_000)], MANIFEST_SCHEMA)
    store.append(MANIFEST, entry)
    read = store.read_bronze("banking")
    assert read.count() == 80_000
    assert read.groupBy(F.spark_partition_id()).count().count() > 1
