"""CSV drops and streams, from files written out of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilwork.operators.profile import profile_columns, text_values
from veilwork.plans import profiles, silver, star
from veilwork.queries import query
from veilwork.queries.views import AS_OF, audit_log, raw_domain
from veilwork.schemas import DOMAINS
from veilwork.session import scratch_path
from veilwork.sources import compact, footers
from veilwork.sources.csv_drop import ingest, list_files
from veilwork.sources.tables import TableStore
from veilwork.streaming import audit, ingest as stream


def _drop(spark, folder, names=tuple(DOMAINS)):
    """A drop folder with the derived records of some domains as CSV files."""
    drop = scratch_path(spark, "drop")
    for name in names:
        rows = raw_domain(spark, folder, name).drop("_bronze_id")
        rows.write.mode("append").option("header", True).option("escape", '"').csv(drop)
    return drop


def _store(spark):
    return TableStore(spark, scratch_path(spark, "warehouse"))


@query("bronze_ingest")
def _(spark, folder):
    store = _store(spark)
    ingest(store, _drop(spark, folder))
    out = None
    for name in DOMAINS:
        rows = store.read_bronze(name)
        one = rows.agg(
            F.lit(name).alias("domain"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("_bronze_id").alias("ids"),
            F.count_distinct("_ingestion_batch_id").alias("batches"),
            F.count_if(F.col("email").contains("@")).alias("emails"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("bronze_second_run")
def _(spark, folder):
    """A second run over the same files finds all of them known."""
    store = _store(spark)
    drop = _drop(spark, folder, ("banking", "marketing"))
    ingest(store, drop)
    again = ingest(store, drop)
    return again.select(
        (F.col("files_found") == F.col("files_skipped")).alias("all_skipped"), "files_failed", "rows_ingested"
    )


@query("file_signatures")
def _(spark, folder):
    files = list_files(spark, _drop(spark, folder, ("banking",)))
    return files.select("name", "size", "signature")


@query("signature_rules")
def _(spark, folder):
    """Signatures: the file's name, size and time in them, one per file, and the same on a second listing."""
    drop = _drop(spark, folder)
    files, again = list_files(spark, drop), list_files(spark, drop)
    parts = F.split("signature", r"\|")
    return files.agg(
        (F.count(F.lit(1)) == F.count_distinct("signature")).alias("one_each"),
        F.bool_and((parts[0] == F.col("name")) & (parts[1] == F.col("size").cast("string"))).alias("named_and_sized"),
        F.bool_and(F.timestamp_micros(parts[2].cast("bigint")).between(F.lit("2000-01-01").cast("timestamp"), F.now())).alias("dated"),
        F.lit(files.exceptAll(again).isEmpty()).alias("repeatable"),
    )


@query("manifest")
def _(spark, folder):
    """Rows per domain as entered in the manifest."""
    store = _store(spark)
    ingest(store, _drop(spark, folder))
    return store.manifest().groupBy("domain").agg(F.sum("rows").alias("rows"))


@query("ingest_to_silver")
def _(spark, folder):
    """Counts of the Silver run after ingesting all four domains from files."""
    store = _store(spark)
    ingest(store, _drop(spark, folder))
    return silver.process_all(store, AS_OF)


@query("ingest_to_star")
def _(spark, folder):
    """Fact rows per domain after two runs of the whole chain; the second adds none."""
    store = _store(spark)
    drop = _drop(spark, folder)
    for _ in range(2):
        ingest(store, drop)
        silver.process_all(store, AS_OF)
        added = star.load_all_stars(store)
    rows = []
    for name, spec in DOMAINS.items():
        rows.append((name, star.star_tables(store, spec)[spec.fact.name].count(), added[name][spec.fact.name]))
    return spark.createDataFrame(rows, "domain string, fact_rows bigint, added_by_second_run bigint")


def _two_batches(spark, folder, domains=tuple(DOMAINS)):
    """A store after two drops of some domains, rows with even ids first, and the rows per table after each."""
    store, counts = _store(spark), []
    for half in (0, 1):
        drop = scratch_path(spark, "drop")
        for name in domains:
            rows = raw_domain(spark, folder, name).where(F.col("_bronze_id") % 2 == half).drop("_bronze_id")
            rows.write.mode("append").option("header", True).option("escape", '"').csv(drop)
        ingest(store, drop)
        found = {}
        for name in domains:
            spec = DOMAINS[name]
            silver.process_domain(store, name, AS_OF)
            star.load_star(store, name)
            found[name, f"silver_{name}"] = store.read(f"silver/{name}", spec.silver_schema).count()
            found |= {(name, table): df.count() for table, df in star.star_tables(store, spec).items()}
        counts.append(found)
    return store, counts


@query("star_two_batches")
def _(spark, folder):
    """Rows per Silver and star table after each of two batches into keyed tables."""
    _, (first, both) = _two_batches(spark, folder)
    rows = [(*key, n, both[key]) for key, n in first.items()]
    return spark.createDataFrame(rows, "domain string, table_name string, after_first bigint, after_both bigint")


@query("facts_two_batches")
def _(spark, folder):
    """The patients, doctors, places and days behind each medical fact after two batches."""
    store, _ = _two_batches(spark, folder, ("medical",))
    tables = star.star_tables(store, DOMAINS["medical"])
    fact = tables["fact_admission"]
    for dim, key in (("dim_patient", "patient_key"), ("dim_doctor", "doctor_key"), ("dim_location", "location_key")):
        fact = fact.join(tables[dim], key, "left")
    days = tables["dim_date"].select(F.col("date_key").alias("admission_date_key"), "full_date")
    return fact.join(days, "admission_date_key", "left").select(
        "patient_id", "first_name", "doctor_name", "address", "city", "full_date"
    )


@query("profile_by_loads")
def _(spark, folder):
    """Banking profiles merged from the sketches of two loads, each read once.

    Counters are exact; unique_close and median_close tell whether the sketches are within 5 %
    of the exact number of distinct values, and within 3 % of the ranks around the median.
    """
    store = _store(spark)
    sketched = 0
    for half in (0, 1):
        drop = scratch_path(spark, "drop")
        rows = raw_domain(spark, folder, "banking").where(F.col("_bronze_id") % 2 == half).drop("_bronze_id")
        rows.write.option("header", True).option("escape", '"').csv(drop)
        ingest(store, drop)
        sketched += profiles.profile_loads(store, "banking").count()
    found = profiles.bronze_profile(store, "banking")
    cells = store.read_bronze("banking").select(*DOMAINS["banking"].source_columns)
    exact = profile_columns(cells, exact_unique=True).select("column_name", F.col("unique_ratio").alias("_unique"))
    length = F.length("value")
    around = F.percentile(length, F.array(F.lit(0.47), F.lit(0.53)))
    ranks = text_values(cells).groupBy(F.col("column_name").alias("_column")).agg(around.alias("_around"))
    joined = found.join(exact, "column_name").join(ranks, F.col("column_name") == F.col("_column"))
    return joined.select(
        "column_name", "records", "values", *[F.round(c, 6).alias(c) for c in found.columns[3:13] + ["avg_length", "std_length", "avg_word_count", "digit_value_ratio"] if c != "unique_ratio"],
        "min_length", "max_length",
        (F.abs(F.col("unique_ratio") - F.col("_unique")) <= 0.05 * F.col("_unique")).alias("unique_close"),
        F.col("median_length").between(F.floor(F.col("_around")[0]), F.ceil(F.col("_around")[1])).alias("median_close"),
        F.lit(sketched).cast("bigint").alias("loads_sketched"),
    )


@query("counts_from_footers")
def _(spark, folder):
    """Rows and values of the loaded education tables, without reading a column."""
    store, spec = _store(spark), DOMAINS["education"]
    ingest(store, _drop(spark, folder, ("education",)))
    silver.process_domain(store, "education", AS_OF)
    star.load_star(store, "education")
    tables = {f"star_education/{d.name}": star.dim_schema(spec, d) for d in spec.dims}
    tables |= {f"star_education/{spec.fact.name}": star.fact_schema(spec), "silver/education": spec.silver_schema}
    return footers.stored_counts(store, tables)


@query("stream_to_silver")
def _(spark, folder):
    """Banking files through the Bronze and Silver streams, twice."""
    store = _store(spark)
    drop = _drop(spark, folder, ("banking",))
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream.stream_bronze(store, drop, f"{checkpoint}/bronze").awaitTermination()
        stream.stream_silver(store, "banking", AS_OF, f"{checkpoint}/silver").awaitTermination()
    rows = store.read("silver/banking", DOMAINS["banking"].silver_schema)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_id").alias("customers"),
    )


@query("stream_all_domains")
def _(spark, folder):
    """All domains through one Silver stream in two rounds, with a repeat of every epoch at the end.

    Per domain: rows, keys and the sum of the keys, and what the repeats added.
    """
    store = _store(spark)
    drop, checkpoint = scratch_path(spark, "drop"), scratch_path(spark, "checkpoint")
    for half in (0, 1):
        for name in DOMAINS:
            rows = raw_domain(spark, folder, name).where(F.col("_bronze_id") % 2 == half).drop("_bronze_id")
            rows.write.mode("append").option("header", True).option("escape", '"').csv(drop)
        stream.stream_bronze(store, drop, f"{checkpoint}/bronze").awaitTermination()
        stream.stream_silver(store, None, AS_OF, f"{checkpoint}/silver").awaitTermination()
    entries, runs = store.manifest(), store.read(silver.RUNS, silver.RUNS_SCHEMA)
    epochs = [r["run_id"] for r in runs.select("run_id").distinct().collect()]
    out = None
    for name, spec in DOMAINS.items():
        again = sum(stream.settle_epoch(store, spec, AS_OF, entries, epoch) for epoch in epochs)
        key = F.col(spec.primary_key)
        one = store.read(f"silver/{name}", spec.silver_schema).agg(
            F.lit(name).alias("domain"), F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"),
            F.sum(key).alias("key_sum"), F.lit(again).cast("bigint").alias("added_by_repeats"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def _bronze_digest(store):
    """Rows, ids and a digest of the customers in Bronze banking."""
    return store.read_bronze("banking").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_bronze_id").alias("ids"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum(F.length("address")).alias("address_chars"),
        F.count_if(F.col("address").contains("\n")).alias("broken_addresses"),
    )


@query("stream_two_folders")
def _(spark, folder):
    """Two folders, each with a checkpoint of its own, into one store."""
    store = _store(spark)
    rows = raw_domain(spark, folder, "banking")
    for i in range(2):
        drop, part = scratch_path(spark, "drop"), rows.where(F.col("_bronze_id") % 2 == i).drop("_bronze_id")
        part.write.option("header", True).option("escape", '"').csv(drop)
        stream.stream_bronze(store, drop, scratch_path(spark, "checkpoint")).awaitTermination()
    return _bronze_digest(store)


@query("stream_line_breaks")
def _(spark, folder):
    """Addresses with line breaks and quotes inside, through the stream."""
    store, drop = _store(spark), scratch_path(spark, "drop")
    rows = raw_domain(spark, folder, "banking").drop("_bronze_id")
    rows = rows.withColumn("address", F.concat(F.lit('Flat "1",\n'), F.col("address")))
    rows.write.option("header", True).option("escape", "\"").option("quoteAll", True).option("ignoreTrailingWhiteSpace", False).csv(drop)
    stream.stream_bronze(store, drop, scratch_path(spark, "checkpoint")).awaitTermination()
    return _bronze_digest(store)


@query("stream_header_order")
def _(spark, folder):
    """Files with reversed columns, odd spellings of the names, an index column and an extra one."""
    store, drop = _store(spark), scratch_path(spark, "drop")
    rows = raw_domain(spark, folder, "banking").drop("_bronze_id")
    names = [F.col(c).alias(f" {c.upper().replace('_', ' ')}") for c in reversed(rows.columns)]
    rows.select(F.lit(7).alias("index"), *names, F.lit("x").alias("note")).write.option("header", True).option(
        "escape", '"'
    ).csv(drop)
    stream.stream_bronze(store, drop, scratch_path(spark, "checkpoint")).awaitTermination()
    return _bronze_digest(store)


@query("packed_loads")
def _(spark, folder):
    """Bronze banking after eight small loads were packed, and what a reader planned before sees."""
    store = _store(spark)
    rows = raw_domain(spark, folder, "banking")
    for i in range(8):
        drop = scratch_path(spark, "drop")
        rows.where(F.col("_bronze_id") % 8 == i).drop("_bronze_id").write.option("header", True).option("escape", '"').csv(drop)
        ingest(store, drop)
    reader = _bronze_digest(store)
    packed = compact.pack_loads(store, "banking")
    files = compact.files_read(store, "banking")
    same = _bronze_digest(store).intersect(reader).count()
    return _bronze_digest(store).select("*", F.lit(packed).cast("bigint").alias("loads_packed"), F.lit(files).cast("bigint").alias("files"), F.lit(same == 1).alias("same_rows"))


@query("batch_then_stream")
def _(spark, folder):
    """Files that a batch run has loaded add nothing when a stream comes upon them."""
    store, drop = _store(spark), _drop(spark, folder, ("banking",))
    ingest(store, drop)
    stream.stream_bronze(store, drop, scratch_path(spark, "checkpoint")).awaitTermination()
    return _bronze_digest(store)


@query("ingest_faults")
def _(spark, folder):
    """A drop with missing columns and a file that fits no domain: the others are loaded."""
    store, drop = _store(spark), scratch_path(spark, "drop")
    rows = raw_domain(spark, folder, "banking")
    few = rows.select("customer_id", "account_number", "account_type", "balance")
    few.write.option("header", True).option("escape", '"').csv(drop)
    rows.select(F.col("email").alias("a"), F.col("phone").alias("b")).coalesce(1).write.mode("append").option(
        "header", True
    ).csv(drop)
    done = ingest(store, drop)
    loaded = store.read_bronze("banking").agg(
        F.count(F.lit(1)).alias("rows"), F.count("email").alias("emails"), F.count("balance").alias("balances")
    )
    return done.select((F.col("files_found") - F.col("files_ingested")).alias("left_out"), "files_failed").withColumn("one", F.lit(1)).join(loaded.withColumn("one", F.lit(1)), "one").drop("one")


@query("stream_audit")
def _(spark, folder):
    """Finished audit windows from a stream of the access log."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("log", "audit", "checkpoint"))
    log = audit_log(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    log.write.parquet(source)
    live = spark.readStream.schema(log.schema).parquet(source)
    audit.write_audit(live, target, checkpoint).awaitTermination()
    done = spark.read.parquet(target)
    return done.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("csv_export")
def _(spark, folder):
    """Accepted records written as CSV and read back."""
    path = scratch_path(spark, "export")
    rows = silver.accepted(raw_domain(spark, folder, "banking"), DOMAINS["banking"], AS_OF)
    rows.select("customer_id", "email", "address").write.option("header", True).csv(path)
    return spark.read.schema("customer_id bigint, email string, address string").option("header", True).csv(path)
