import csv
import io
import random

import pytest

from veilwork.sources.csv_drop import ingest, probe


def make(seed, rows, end):
    rng = random.Random(seed)
    pieces = ["a", " ", '"', ",", "\n", "\n\n", "xyz", "é", "1,2", '"q"', "\r\n"]
    data = [["".join(rng.choices(pieces, k=rng.randrange(5))) or "v" for _ in range(4)] for _ in range(rows)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["customer_id", "account_number", "account_type", "balance"])
    writer.writerows(data)
    return data, out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_match_the_csv_module(spark, store, tmp_path, end):
    wanted = {}
    for seed in range(3):
        data, text = make(seed, 400, end)
        (tmp_path / f"f{seed}.csv").write_bytes(text.encode())
        wanted[f"f{seed}.csv"] = data
    (tmp_path / "plain.csv").write_bytes(b'customer_id,account_number,account_type,balance\n1,"x,y",6"2,b\n2,,"z",\n')
    paths = [str(tmp_path / n) for n in [*wanted, "plain.csv"]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        seen = {r["name"]: (r["header"].rstrip("\r"), r["multiline"]) for r in probe(spark, paths).collect()}
        ingest(store, str(tmp_path))
        rows = store.read_bronze("banking").orderBy("_bronze_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    head = "customer_id,account_number,account_type,balance"
    assert seen == {**{n: (head, True) for n in wanted}, "plain.csv": (head, False)}
    assert len({r["_bronze_id"] for r in rows}) == len(rows)
    for name, data in wanted.items():
        got = [[r[c] for c in head.split(",")] for r in rows if r["_source_file"] == name]
        assert got == data


def test_ingest_of_one_long_quoted_field(spark, store, tmp_path):
    long = "\n".join(f"line {i}" for i in range(3000))
    head = "customer_id,first_name,campaign_name,campaign_date,channel\n"
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "m.csv").write_text(head + f'1,Ann,"{long}",01/01/2020,SMS\n\n2,Bob,x,01/01/2020,SMS\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        ingest(store, str(folder))
        rows = store.read_bronze("marketing").orderBy("_bronze_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["customer_id"], r["campaign_name"]) for r in rows] == [("1", long), ("2", "x")]
