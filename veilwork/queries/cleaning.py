"""Field cleaners and row rules over the derived records."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilwork.functions import cleaners as C
from veilwork.operators.dedupe import absent_signatures, duplicate_groups, first_per_key, signature
from veilwork.operators.joins import absent_from, insert_ignore
from veilwork.plans import silver
from veilwork.queries import query
from veilwork.queries.views import AS_OF, raw_domain, table
from veilwork.schemas import DOMAINS, SENSITIVITY_POLICY


def _column_query(name, domain, **columns):
    """One query that applies functions to columns of a domain's raw records."""

    @query(name)
    def run(spark, folder):
        rows = raw_domain(spark, folder, domain)
        return rows.select("_bronze_id", *[fn(F.col(c)).alias(out) for out, (c, fn) in columns.items()])


_column_query("is_missing", "marketing", missing=("customer_id", C.is_missing))
_column_query("clean_text", "education", course=("course", C.clean_text), department=("department", C.clean_text))
_column_query("clean_name", "banking", first_name=("first_name", C.clean_name), last_name=("last_name", C.clean_name))
_column_query("clean_email", "banking", email=("email", C.clean_email))
_column_query("is_valid_email", "education", valid=("email", C.is_valid_email))
_column_query("clean_phone", "banking", phone=("phone", C.clean_phone))
_column_query("is_valid_phone", "education", valid=("phone", C.is_valid_phone))
_column_query("clean_date", "banking", date_of_birth=("date_of_birth", C.clean_date))
_column_query("clean_int", "education", student_id=("student_id", C.clean_int))
_column_query("clean_amount", "banking", balance=("balance", C.clean_amount))
_column_query("clean_percentage", "education", percentage=("percentage", C.clean_percentage))
_column_query("clean_age", "marketing", age=("age", lambda c: C.clean_age(c).cast("bigint")))
_column_query("clean_upper", "marketing", channel=("channel", C.clean_upper))
_column_query("clean_account_type", "banking", account_type=("account_type", C.clean_account_type))
_column_query("clean_gender", "marketing", gender=("gender", C.clean_gender))
_column_query("clean_blood_group", "medical", blood_group=("blood_group", C.clean_blood_group))
_column_query("clean_channel", "marketing", channel=("channel", C.clean_channel))
_column_query("clean_account_number", "banking", account_number=("account_number", C.clean_account_number))
_column_query(
    "clean_medical_record_number", "medical",
    medical_record_number=("medical_record_number", C.clean_medical_record_number),
)


@query("clean_location")
def _(spark, folder):
    return C.with_location(raw_domain(spark, folder, "education").select("_bronze_id", "address"))


@query("clean_text_documents")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", C.clean_text(F.col("text")).alias("clean"))
    return docs.select("doc_id", F.length("clean").cast("bigint").alias("n"), F.md5("clean").alias("digest"))


@query("date_is_not_future")
def _(spark, folder):
    rows = raw_domain(spark, folder, "education").select("_bronze_id", C.clean_date(F.col("date_of_birth")).alias("d"))
    return rows.select("_bronze_id", C.date_is_not_future(F.col("d"), F.lit(AS_OF)).alias("ok"))


@query("admission_is_consistent")
def _(spark, folder):
    rows = raw_domain(spark, folder, "medical").select(
        "_bronze_id",
        C.clean_date(F.col("admission_date")).alias("a"),
        C.clean_date(F.col("date_of_birth")).alias("b"),
    )
    return rows.select("_bronze_id", C.admission_is_consistent(F.col("a"), F.col("b")).alias("ok"))


@query("as_date")
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", C.as_date(F.col("o_orderdate")).alias("day"))


@query("comparable_values")
def _(spark, folder):
    rows = silver.cleaned(raw_domain(spark, folder, "banking"), DOMAINS["banking"], AS_OF)
    types = dict(rows.dtypes)
    columns = ("customer_id", "first_name", "date_of_birth", "account_type", "balance", "city")
    return rows.select("_bronze_id", *[C.comparable(F.col(c), types[c]).alias(c) for c in columns])


# ---- rows ---------------------------------------------------------------------------


@query("common_fields")
def _(spark, folder):
    names = {"first_name", "last_name", "email", "phone", "address"}
    return silver.clean_fields(raw_domain(spark, folder, "marketing"), DOMAINS["marketing"], names)


@query("date_rules")
def _(spark, folder):
    spec = DOMAINS["medical"]
    rows = silver.clean_fields(raw_domain(spark, folder, "medical"), spec, {"admission_date", "date_of_birth"})
    return silver.apply_date_rules(rows, spec, AS_OF)


@query("critical_faults")
def _(spark, folder):
    spec = DOMAINS["education"]
    rows = silver.clean_fields(raw_domain(spark, folder, "education"), spec, {"student_id", "first_name"})
    return rows.select("_bronze_id", silver.row_fault(spec).alias("fault"))


def _silver_queries(name):
    spec = DOMAINS[name]

    @query(f"silver_{name}")
    def accepted(spark, folder):
        rows = silver.accepted(raw_domain(spark, folder, name), spec, AS_OF)
        if name == "marketing":
            rows = rows.withColumn("age", F.col("age").cast("bigint"))
        return rows

    @query(f"classified_{name}")
    def classified(spark, folder):
        rows = silver.classified(raw_domain(spark, folder, name), spec, AS_OF)
        return rows.select("_bronze_id", spec.primary_key, "first_name", "reject_reason")


for _name in DOMAINS:
    _silver_queries(_name)


@query("rejected_rows")
def _(spark, folder):
    rows = silver.rejected(raw_domain(spark, folder, "banking"), DOMAINS["banking"], AS_OF)
    return rows.select("_bronze_id", "reject_reason")


@query("silver_run_stats")
def _(spark, folder):
    out = None
    for name, spec in DOMAINS.items():
        one = silver.batch_stats(raw_domain(spark, folder, name), spec)
        out = one if out is None else out.unionByName(one)
    return silver.with_totals(out)


@query("not_null_filter")
def _(spark, folder):
    rows = silver.cleaned(raw_domain(spark, folder, "banking"), DOMAINS["banking"], AS_OF)
    return rows.where("account_number IS NOT NULL").select("_bronze_id", "account_number")


@query("in_list_filter")
def _(spark, folder):
    return table(spark, folder, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", "c_mktsegment"
    )


@query("conditional_columns")
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", True).otherwise(False).alias("returned"),
        F.when(F.col("l_quantity") >= 30, "BULK").when(F.col("l_quantity") >= 10, "PACK").otherwise("UNIT").alias("size"),
    )


@query("sensitivity_policy")
def _(spark, folder):
    from veilwork.plans.gold import with_sensitivity

    types = list(SENSITIVITY_POLICY)
    picked = F.element_at(F.array(*[F.lit(t) for t in types]), (F.col("l_partkey") % len(types) + 1).cast("int"))
    rows = table(spark, folder, "lineitem").select(picked.alias("pii_type"), "l_quantity")
    return with_sensitivity(rows).groupBy("pii_type", "sensitivity_level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


# ---- incremental processing -----------------------------------------------------------


@query("skip_processed")
def _(spark, folder):
    done = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("_bronze_id"))
    rows = raw_domain(spark, folder, "education").select("_bronze_id", "student_id")
    return absent_from(rows, done, ["_bronze_id"])


def _halves(spark, folder):
    """Silver after a first batch of banking rows, and the second batch."""
    raw = raw_domain(spark, folder, "banking")
    first = raw.where("first_name LIKE '%building%' OR first_name LIKE '%machinery%'")
    return silver.accepted(first, DOMAINS["banking"], AS_OF), raw


@query("silver_second_batch")
def _(spark, folder):
    done, raw = _halves(spark, folder)
    return silver.accepted(raw, DOMAINS["banking"], AS_OF, done).select("_bronze_id", "customer_id", "email")


@query("classified_second_batch")
def _(spark, folder):
    done, raw = _halves(spark, folder)
    return silver.classified(raw, DOMAINS["banking"], AS_OF, done).select("_bronze_id", "customer_id", "reject_reason")


@query("dedupe_first_wins")
def _(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return first_per_key(rows, ["user_id", "event_type"], ["event_id"])


@query("row_signature")
def _(spark, folder):
    rows = silver.cleaned(raw_domain(spark, folder, "education"), DOMAINS["education"], AS_OF)
    columns = ("first_name", "last_name", "date_of_birth", "course", "department", "percentage")
    return rows.select("_bronze_id", signature(rows, columns).alias("signature"))


@query("duplicate_groups")
def _(spark, folder):
    rows = silver.cleaned(raw_domain(spark, folder, "medical"), DOMAINS["medical"], AS_OF)
    return duplicate_groups(rows, ("first_name", "email", "blood_group", "doctor_name", "diagnosis"), "_bronze_id")


@query("duplicate_documents")
def _(spark, folder):
    return duplicate_groups(table(spark, folder, "documents"), ("text",), "doc_id")


@query("exact_duplicates_refused")
def _(spark, folder):
    rows = silver.cleaned(raw_domain(spark, folder, "marketing"), DOMAINS["marketing"], AS_OF)
    columns = ("first_name", "email", "gender", "campaign_date")
    known = rows.where("channel = 'EMAIL'")
    return absent_signatures(rows.where("channel <> 'EMAIL' OR channel IS NULL"), columns, known).select("_bronze_id")


@query("insert_ignore")
def _(spark, folder):
    events = table(spark, folder, "events")
    known = events.where("event_type = 'click' AND value > 150").select("user_id").distinct()
    new = events.where("event_type <> 'click'").select("user_id", F.lit("seen").alias("state"))
    return insert_ignore(new, known, ["user_id"])
