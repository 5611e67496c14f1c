"""The PII catalog, masking, role views, free-text scans and reports."""

from __future__ import annotations

import contextlib
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from veilwork.functions import masks as M
from veilwork.operators import dependencies
from veilwork.operators.keys import stable_hash
from veilwork.operators.profile import column_counts
from veilwork.plans import access, gold, persons, reports, rules, silver
from veilwork.plans.star import dimension_rows, fact_rows, row_counts
from veilwork.queries import query
from veilwork.queries.views import AS_OF, audit_log, raw_domain, table
from veilwork.queries.warehouse import BUCKETS, silver_rows
from veilwork.schemas import DOMAINS, star_constraints, star_references
from veilwork.session import materialize, scratch_path
from veilwork.sources.tables import TableStore

AT = dt.datetime(2026, 1, 1, 12, 0, 0)


def warehouse(spark, folder):
    """Star tables of all domains, written once so that every scan pass reads them back."""
    out = {}

    def settle(item):
        table_name, df = item
        return table_name, materialize(df, table_name)

    def load(name):
        # Settled first, since each star table is derived from it.
        rows = materialize(silver_rows(spark, folder, name), f"silver-{name}")
        spec = DOMAINS[name]
        lazy = {d.name: dimension_rows(rows, d, buckets=BUCKETS) for d in spec.dims}
        with ThreadPoolExecutor(4) as pool:
            dims = dict(pool.map(settle, lazy.items()))
        tables = dims | {spec.fact.name: materialize(fact_rows(rows, spec, dims), spec.fact.name)}
        return {(f"star_{name}", table_name): df for table_name, df in tables.items()}

    # The domains are independent of one another.
    with ThreadPoolExecutor(len(DOMAINS)) as pool:
        for tables in pool.map(load, DOMAINS):
            out |= tables
    return out


def row_hashes(tables):
    """Sampling order by the row's own key, so that other engines can repeat it."""
    return {
        name: stable_hash(F.col("_bronze_id" if "_bronze_id" in df.columns else df.columns[0]))
        for name, df in tables.items()
    }


def features_of(spark, tables):
    inventory = gold.column_inventory(
        gold.catalog_columns(spark, tables), gold.constraint_rows(spark, star_constraints())
    )
    return gold.column_features(gold.scan_inputs(tables, row_hashes(tables)), inventory)


def rule_scan(spark, tables):
    return gold.scan_outcome(rules.classify_by_rules(features_of(spark, tables)))


@query("column_inventory")
def _(spark, folder):
    """Catalogued columns with their key flags and row counts."""
    tables = warehouse(spark, folder)
    inventory = gold.column_inventory(
        gold.catalog_columns(spark, tables), gold.constraint_rows(spark, star_constraints())
    )
    counts = None
    for (schema, name), df in tables.items():
        part = column_counts(df).select(F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "*")
        counts = part if counts is None else counts.unionByName(part)
    joined = inventory.join(counts, ["schema_name", "table_name", "column_name"])
    return joined.select(
        "schema_name", "table_name", "column_name", "table_type", "is_primary_key", "is_foreign_key",
        F.col("ordinal_position").cast("bigint").alias("ordinal_position"), "records_scanned", "non_null_records",
    )


@query("rule_classify_columns")
def _(spark, folder):
    scan = rule_scan(spark, warehouse(spark, folder))
    return scan.select(
        "schema_name", "table_name", "column_name", "pii_type", F.round("final_confidence", 6).alias("confidence"),
        "detection_method", "evidence", "records_scanned", "pii_detected", "pii_records_detected",
    )


def _scans(spark, folder):
    """Catalog dimensions and two scans of the warehouse, a day apart."""
    tables = warehouse(spark, folder)
    dims = gold.catalog_additions(gold.catalog_columns(spark, tables), {})
    scan = gold.resolve_keys(materialize(rule_scan(spark, tables), "scan"), dims)
    first = gold.scan_fact(scan, AT, "rules-1", "scan-1")
    second = gold.scan_fact(scan, AT + dt.timedelta(days=1), "rules-1", "scan-2")
    return first.unionByName(second), dims


@query("pii_scan_fact")
def _(spark, folder):
    fact, _ = _scans(spark, folder)
    return fact.groupBy("scan_id", F.col("date_key").cast("bigint").alias("date_key")).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_distinct("column_key").alias("distinct_columns"),
        F.count_if("pii_detected").alias("pii_columns"),
        F.sum("records_scanned").alias("records_scanned"),
        F.sum("pii_records_detected").alias("pii_records"),
    )


@query("gold_row_counts")
def _(spark, folder):
    fact, dims = _scans(spark, folder)
    return row_counts(dims | {"fact_pii_scan": fact})


@query("latest_scan")
def _(spark, folder):
    fact, dims = _scans(spark, folder)
    newest = gold.latest_scan(fact).join(dims["dim_column"], "column_key")
    return newest.select("column_name", "scan_id", "pii_detected", "pii_records_detected")


def catalog(spark, folder):
    fact, dims = _scans(spark, folder)
    return reports.apply_masking_policy(reports.pii_catalog(gold.latest_scan(fact), dims))


@query("pii_catalog")
def _(spark, folder):
    rows = catalog(spark, folder)
    return rows.withColumn("confidence", F.round("confidence", 6))


@query("pii_inventory")
def _(spark, folder):
    return reports.pii_inventory(catalog(spark, folder))


@query("sensitivity_distribution")
def _(spark, folder):
    return reports.sensitivity_distribution(catalog(spark, folder))


@query("sensitivity_by_domain")
def _(spark, folder):
    return reports.sensitivity_by(catalog(spark, folder), "domain")


@query("sensitivity_by_type")
def _(spark, folder):
    return reports.sensitivity_by(catalog(spark, folder), "pii_type")


@query("masking_coverage")
def _(spark, folder):
    rows = reports.masking_coverage(catalog(spark, folder))
    return rows.withColumn("coverage", F.round("coverage", 6))


@query("scan_outcome")
def _(spark, folder):
    """Columns scanned and flagged per schema."""
    scan = rule_scan(spark, warehouse(spark, folder))
    return scan.groupBy("schema_name").agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if("pii_detected").alias("pii_columns"),
        F.sum("pii_records_detected").alias("pii_records"),
    )


@query("rule_formats")
def _(spark, folder):
    """Customers' record numbers, cards, accounts and dates under names that say nothing of them."""
    key = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("MRN-2025-"), F.lpad(key, 5, "0")).alias("campaign"),
        F.when(even, "4111 1111 1111 1111").otherwise("5500005555555559").alias("course"),
        F.when(even, "4111111111111112").otherwise((F.col("c_custkey") + 100000000000).cast("string")).alias("department"),
        F.concat(F.lit("12/07/"), (F.col("c_custkey") % 50 + 1950).cast("string")).alias("channel"),
        F.concat(F.lit("12/07/"), (F.col("c_custkey") % 5 + 2020).cast("string")).alias("note"),
    )
    tables = {("star_banking", "dim_hidden"): rows}
    return rules.classify_by_rules(features_of(spark, tables)).select(
        "column_name", "pii_type", F.col("final_confidence").cast("double").alias("final_confidence"), "evidence"
    )


# ---- keys found in the data -------------------------------------------------------------


def _checked(tables):
    references = star_references()
    return dependencies.check_constraints(tables, [b for _, b in references], references)


@query("declared_keys")
def _(spark, folder):
    """Every declared key of the star tables, checked against the data."""
    return _checked(warehouse(spark, folder))


@query("broken_keys")
def _(spark, folder):
    """The same with planted faults: diagnoses that are gone, doctors that are there twice, places without a key."""
    tables = warehouse(spark, folder)
    diagnoses, doctors, places = (("star_medical", f"dim_{x}") for x in ("diagnosis", "doctor", "location"))
    tables[diagnoses] = tables[diagnoses].where("diagnosis NOT LIKE '%7'")
    tables[doctors] = tables[doctors].unionByName(tables[doctors].where("doctor_name LIKE '%Rao'"))
    tables[places] = tables[places].withColumn("location_key", F.when(F.col("city") != "Ranchi", F.col("location_key")))
    return _checked({k: v for k, v in tables.items() if k[0] == "star_medical"} | {
        k: v for k, v in tables.items() if k[0] != "star_medical"
    }).where("schema_name = 'star_medical' AND violations > 0")


@query("inclusion_dependencies")
def _(spark, folder):
    """Columns of the given tables all of whose values occur in another column."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels", "documents")
    tables = {("given", n): table(spark, folder, n) for n in names}
    keys = {k: df.select(*[c for c, t in df.dtypes if t in ("bigint", "int")]) for k, df in tables.items()}
    columns = dependencies.column_names(keys)
    found = dependencies.inclusions(dependencies.column_values(keys), len(columns))
    listed = F.array(*map(F.lit, [".".join(x[1:]) for x in columns]))
    return found.select(F.get(listed, "column").alias("column_name"), F.get(listed, "within").alias("within_column"))


# ---- masking --------------------------------------------------------------------------


def _banking(spark, folder):
    return silver.cleaned(raw_domain(spark, folder, "banking"), DOMAINS["banking"], AS_OF)


@query("mask_email")
def _(spark, folder):
    return _banking(spark, folder).select("_bronze_id", M.mask_email(F.col("email")).alias("email"))


@query("mask_phone")
def _(spark, folder):
    return _banking(spark, folder).select("_bronze_id", M.mask_tail(F.col("phone")).alias("phone"))


@query("mask_account_number")
def _(spark, folder):
    rows = _banking(spark, folder)
    return rows.select("_bronze_id", M.mask_tail(F.col("account_number")).alias("account_number"))


@query("mask_others")
def _(spark, folder):
    return _banking(spark, folder).select(
        "_bronze_id",
        M.mask_name(F.col("first_name")).alias("first_name"),
        M.mask_birth_date(F.col("date_of_birth")).alias("date_of_birth"),
        M.redact(F.col("address")).alias("address"),
        M.pseudonym(F.col("customer_id"), F.lit("k1")).alias("customer_id"),
    )


@query("mask_raw_values")
def _(spark, folder):
    """Masks of uncleaned values: without the format, short, single characters, empty."""
    raw = raw_domain(spark, folder, "banking")
    return raw.select(
        "_bronze_id",
        M.mask_email(F.col("email")).alias("email"),
        M.mask_email(F.concat_ws("@", F.lit(""), F.col("phone"))).alias("no_user"),
        M.mask_tail(F.col("phone")).alias("phone"),
        M.mask_tail(F.substring("phone", 1, 4)).alias("short"),
        M.mask_name(F.col("first_name")).alias("first_name"),
        M.mask_name(F.substring("first_name", 1, 1)).alias("one_letter"),
    )


@query("redact_record_numbers")
def _(spark, folder):
    """Record numbers of several spellings inside running text."""
    text = F.concat_ws(
        " ", F.lit("seen"), F.concat(F.lit("MRN-2025-"), F.lpad(F.col("doc_id").cast("string"), 5, "0")),
        F.lit("and"), F.concat(F.lit("mrn-1234"), F.col("doc_id").cast("string"), F.lit("x")), F.lit("Mrn 77 ok"),
    )
    return table(spark, folder, "documents").select("doc_id", access.redact_text(text).alias("clean"))


BANKING_TYPES = {
    "_bronze_id": "NON_PII", "customer_id": "DIRECT_IDENTIFIER", "first_name": "PERSON_NAME",
    "last_name": "PERSON_NAME", "email": "EMAIL", "phone": "PHONE", "date_of_birth": "DATE_OF_BIRTH",
    "account_number": "BANK_ACCOUNT_NUMBER", "account_type": "NON_PII", "balance": "FINANCIAL_INFORMATION",
    "address": "ADDRESS", "city": "LOCATION", "state": "LOCATION",
}


@query("secure_view_analyst")
def _(spark, folder):
    return access.secure_view(_banking(spark, folder), BANKING_TYPES, access.ANALYST, "k1")


@query("secure_view_administrator")
def _(spark, folder):
    return access.secure_view(_banking(spark, folder), BANKING_TYPES, access.ADMINISTRATOR, "k1")


def _audited(spark, folder):
    """A store, the catalog of all domains and the customers of the bank."""
    tables = warehouse(spark, folder)
    dims = gold.catalog_additions(gold.catalog_columns(spark, tables), {})
    scan = gold.resolve_keys(materialize(rule_scan(spark, tables), "scan"), dims)
    rows = reports.pii_catalog(gold.latest_scan(gold.scan_fact(scan, AT, "rules-1", "scan-1")), dims)
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    return store, materialize(rows, "catalog"), tables["star_banking", "dim_customer"]


@query("catalog_role_view")
def _(spark, folder):
    """Customers as an analyst sees them, masked by what the latest scan has found."""
    store, found, customers = _audited(spark, folder)
    return access.audited_view(
        store, found, customers, "star_banking", "dim_customer", "7", access.ANALYST, "k1", AT
    ).drop("customer_key")


@query("access_audit")
def _(spark, folder):
    """The audit log after two reads and a refusal."""
    store, found, customers = _audited(spark, folder)
    for user, role in (("1", access.ADMINISTRATOR), ("2", access.ANALYST), ("3", "Visitor")):
        with contextlib.suppress(access.AccessDenied):
            access.audited_view(store, found, customers, "star_banking", "dim_customer", user, role, "k1", AT)
    log = store.read(access.AUDIT_LOG, access.AUDIT_SCHEMA)
    readable = customers.agg(F.count_if(F.col("customer_id").isNotNull()).alias("customers"))
    return log.select("user_id", "role", "resource", "action", "result", F.lit(1).alias("one")).join(
        readable.withColumn("one", F.lit(1)), "one"
    ).drop("one")


# ---- free text ------------------------------------------------------------------------


def _counts(df):
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


@query("text_scan_documents")
def _(spark, folder):
    return _counts(access.scan_text(table(spark, folder, "documents"), "text", ["doc_id"]))


@query("text_scan_conversations")
def _(spark, folder):
    return _counts(access.scan_text(table(spark, folder, "conversations"), "text", ["conv_id", "turn"]))


@query("text_redact_documents")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", access.redact_text(F.col("text")).alias("clean"))
    return docs.select("doc_id", F.length("clean").cast("bigint").alias("n"), F.md5("clean").alias("digest"))


@query("text_summary_documents")
def _(spark, folder):
    out = access.text_summary(table(spark, folder, "documents"), "text", "lang")
    return out.withColumn("share", F.round("share", 6))


def _span_table(df, text, keep):
    rows = df.select(*keep, access.text_spans(F.col(text)).alias("spans"))
    listed = F.array_join(F.transform("spans", lambda x: F.concat(x["kind"], F.lit("="), x["value"])), "|")
    return persons.span_counts(rows.select(*keep, F.md5(listed).alias("digest"), "spans"), access.REDACT_ORDER)


@query("text_spans_documents")
def _(spark, folder):
    """Spans of personal data per document, each of one kind, card numbers by their check digit."""
    return _span_table(table(spark, folder, "documents"), "text", ["doc_id"])


@query("text_spans_conversations")
def _(spark, folder):
    return _span_table(table(spark, folder, "conversations"), "text", ["conv_id", "turn"])


def _mentioning(spark, folder, name, number):
    """A table's texts, each followed by a sentence about one customer of the bank."""
    raw = raw_domain(spark, folder, "banking").select(
        F.col("_bronze_id").alias("_of"),
        F.concat(F.lit(" Seen: "), F.upper("email"), F.lit(", "), "account_number", F.lit("; "), "first_name",
                 F.lit("  "), "last_name", F.lit(" ("), "phone", F.lit(")")).alias("_said"),
    )
    rows = table(spark, folder, name).withColumn("_of", number)
    return rows.join(raw, "_of", "left").withColumn("text", F.concat("text", F.coalesce("_said", F.lit(""))))


def _known_persons(spark, folder, rows, keep):
    silver_rows = materialize(_banking(spark, folder).select("email", "phone", "account_number", "first_name", "last_name"), "known")
    found = persons.known_spans(rows, persons.known_values([silver_rows]), "text", keep)
    values = F.array_join(F.transform("spans", lambda x: F.lower(x["value"])), "|")
    return persons.span_counts(found.select(*keep, F.md5(values).alias("digest"), "spans"), persons.KINDS[:3] + persons.KINDS[4:])


@query("known_persons_documents")
def _(spark, folder):
    """Customers named in documents: emails, phones, accounts and names, in any case."""
    rows = _mentioning(spark, folder, "documents", F.col("doc_id") % 700)
    return _known_persons(spark, folder, rows, ["doc_id"])


@query("known_persons_conversations")
def _(spark, folder):
    rows = _mentioning(spark, folder, "conversations", F.col("conv_id") * 7 + F.col("turn"))
    return _known_persons(spark, folder, rows, ["conv_id", "turn"])


# ---- audit ----------------------------------------------------------------------------


@query("audit_daily")
def _(spark, folder):
    return reports.audit_report(audit_log(spark, folder))


@query("audit_by_user")
def _(spark, folder):
    return reports.audit_by_user(audit_log(spark, folder))
