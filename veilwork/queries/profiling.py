"""Value formats, column features, counts, samples and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilwork.functions import patterns as P
from veilwork.operators.keys import stable_hash
from veilwork.operators.profile import column_counts, column_samples, profile_columns, unpivot_text
from veilwork.plans import silver
from veilwork.queries import query
from veilwork.queries.views import AS_OF, raw_domain, table
from veilwork.schemas import DOMAINS
from veilwork.session import materialize


@query("split_samples")
def _(spark, folder):
    rows = raw_domain(spark, folder, "banking")
    joined = F.when(F.col("account_type") == "VIP", "null").otherwise(
        F.concat_ws("|", "first_name", "phone", "account_number", "balance")
    )
    parts = P.split_samples(joined)
    return rows.select("_bronze_id", F.size(parts).cast("bigint").alias("n"), F.array_join(parts, ",").alias("parts"))


@query("ratio")
def _(spark, folder):
    grouped = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.col("l_quantity") > 49).alias("n")
    )
    return grouped.select("l_suppkey", F.round(P.ratio(F.col("r"), F.col("n")), 6).alias("ratio"))


@query("format_predicates")
def _(spark, folder):
    rows = raw_domain(spark, folder, "banking")
    long = unpivot_text(rows, [c for c in rows.columns if c != "_bronze_id"], ["_bronze_id"])
    long, value = long.withColumn("value", F.trim("value")), F.col("value")
    return long.select("_bronze_id", "column_name", *[P.looks_like(value, k).alias(k) for k in P.PATTERNS])


@query("as_flag")
def _(spark, folder):
    events = table(spark, folder, "events")
    text = (
        F.when(F.col("event_type") == "click", " Yes")
        .when(F.col("event_type") == "view", "TRUE")
        .when(F.col("event_type") == "error", F.col("user_id").cast("string"))
        .when(F.col("event_type") == "signup", "n")
    )
    return events.select("event_id", P.as_flag(text).cast("bigint").alias("flag"))


@query("keyword_flags")
def _(spark, folder):
    events = table(spark, folder, "events")
    suffix = F.element_at(
        F.array(*[F.lit(x) for x in ("Customer-ID", "email_address", "account-no", "DOB", "blood_group", "full-name")]),
        (F.col("user_id") % 6 + 1).cast("int"),
    )
    flags = P.keyword_flags(F.concat(F.col("event_type"), F.lit("_"), suffix))
    digits = F.array_join(F.transform(flags, lambda x: x.cast("int").cast("string")), "")
    return events.select("event_id", digits.alias("flags"))


@query("semantic_text")
def _(spark, folder):
    rows = raw_domain(spark, folder, "marketing")
    sentence = P.semantic_text(
        P.domain_of_schema(F.concat(F.lit("star_"), F.col("campaign_name"))),
        F.lower(F.replace("campaign_name", F.lit(" "), F.lit("_"))),
        P.table_type(F.lower(F.replace("campaign_name", F.lit("Campaign c"), F.lit("dim_c")))),
        F.col("customer_id"),
        F.lit("text"),
        F.array("first_name", "gender"),
    )
    return rows.select("_bronze_id", sentence.alias("sentence"))


@query("text_or_null_word")
def _(spark, folder):
    rows = raw_domain(spark, folder, "marketing")
    return rows.select("_bronze_id", P.text_or_null_word(F.col("customer_id")).alias("customer_id"))


@query("domain_of_schema")
def _(spark, folder):
    customer = table(spark, folder, "customer")
    schema = F.concat(F.lit("star_"), F.lower("c_mktsegment"))
    return customer.select(
        "c_custkey",
        P.domain_of_schema(schema).alias("domain"),
        F.concat(F.lit("Warehouse table in "), schema).alias("description"),
    )


@query("table_type")
def _(spark, folder):
    part = table(spark, folder, "part")
    prefix = F.when(F.col("p_size") % 3 == 0, "FACT_").when(F.col("p_size") % 3 == 1, "dimX").otherwise("t_")
    return part.select("p_partkey", P.table_type(F.concat(prefix, F.col("p_name"))).alias("table_type"))


def _silver(spark, folder, name):
    return silver.cleaned(raw_domain(spark, folder, name), DOMAINS[name], AS_OF)


@query("column_counts")
def _(spark, folder):
    return column_counts(_silver(spark, folder, "marketing"))


@query("column_counts_lineitem")
def _(spark, folder):
    return column_counts(table(spark, folder, "lineitem"))


def _orders(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority", "o_totalprice")


@query("column_samples")
def _(spark, folder):
    samples = column_samples(_orders(spark, folder), row_hash=stable_hash(F.col("o_orderkey")))
    return samples.select("column_name", F.array_join("samples", "|").alias("samples"))


@query("column_samples_sparse")
def _(spark, folder):
    """Samples of a table with many NULLs and few distinct values."""
    rows = materialize(_silver(spark, folder, "marketing"), "silver-marketing")
    samples = column_samples(rows, row_hash=stable_hash(F.col("_bronze_id")))
    return samples.select("column_name", F.array_join("samples", "|").alias("samples"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("sample_features")
def _(spark, folder):
    samples = column_samples(_orders(spark, folder), row_hash=stable_hash(F.col("o_orderkey")))
    return _rounded(samples.select("column_name", *P.sample_features(F.col("samples"))))


@query("profile_columns")
def _(spark, folder):
    rows = _silver(spark, folder, "medical").drop("_bronze_id")
    return _rounded(profile_columns(rows, exact_unique=True))


@query("profile_conversations")
def _(spark, folder):
    return _rounded(profile_columns(table(spark, folder, "conversations"), exact_unique=True))


@query("profile_approximate")
def _(spark, folder):
    """All columns of lineitem with approximate uniqueness, as used on large tables."""
    return profile_columns(table(spark, folder, "lineitem"))


@query("profile_lineitem")
def _(spark, folder):
    """The approximate profile of lineitem; unique_close tells whether the estimates are within 15 %
    (three standard errors) of the exact share of distinct values."""
    rows = table(spark, folder, "lineitem")
    exact = profile_columns(rows, exact_unique=True).select(F.col("column_name").alias("_name"), F.col("unique_ratio").alias("_unique"))
    found = profile_columns(rows).join(exact, F.col("column_name") == F.col("_name"))
    close = F.abs(F.col("unique_ratio") - F.col("_unique")) <= 0.15 * F.col("_unique")
    return _rounded(found.withColumn("unique_close", close).drop("unique_ratio", "_unique", "_name"))
