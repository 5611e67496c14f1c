"""Star schemas: keys, dimensions, facts and the joins they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilwork.functions.dates import date_key, date_parts
from veilwork.operators.joins import absent_from, present_in, with_lookup
from veilwork.operators.keys import with_surrogate_keys
from veilwork.plans import silver, star
from veilwork.plans.gold import calendar
from veilwork.queries import query
from veilwork.queries.views import AS_OF, raw_domain, table
from veilwork.schemas import DOMAINS
from veilwork.session import materialize

BUCKETS = 64


def silver_rows(spark, folder, name):
    return silver.accepted(raw_domain(spark, folder, name), DOMAINS[name], AS_OF)


def settled_rows(spark, folder, name):
    """Silver rows, written once: every dimension and the fact are derived from them."""
    return materialize(silver_rows(spark, folder, name), f"silver-{name}")


def star_of(spark, folder, name):
    return star.star_in_memory(settled_rows(spark, folder, name), DOMAINS[name], BUCKETS)


def _plain(df):
    """Integers as bigint, so that both engines agree on the type."""
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


def _star_queries(name):
    spec = DOMAINS[name]

    def one(dim):
        @query(f"{name}_{dim.name}")
        def run(spark, folder):
            return _plain(star.dimension_rows(silver_rows(spark, folder, name), dim, buckets=BUCKETS))

    for dim in spec.dims:
        one(dim)

    @query(f"{name}_{spec.fact.name}")
    def fact(spark, folder):
        return _plain(star_of(spark, folder, name)[spec.fact.name])


for _name in DOMAINS:
    _star_queries(_name)


@query("fact_second_load")
def _(spark, folder):
    """Facts and members that a second load adds after a first one of the savings accounts."""
    spec = DOMAINS["banking"]
    rows = settled_rows(spark, folder, "banking")
    old = star.star_in_memory(rows.where("account_type = 'SAVINGS'"), spec, BUCKETS)
    fresh = absent_from(rows, old[spec.fact.name], ["_bronze_id"])
    out = None
    for dim in spec.dims:
        added = star.new_members(fresh, dim, old[dim.name]).agg(F.count(F.lit(1)).alias("added"))
        added = added.select(F.lit(dim.name).alias("table_name"), "added")
        out = added if out is None else out.unionByName(added)
    facts = fresh.agg(F.count(F.lit(1)).alias("added"))
    return out.unionByName(facts.select(F.lit(spec.fact.name).alias("table_name"), "added"))


@query("star_row_counts")
def _(spark, folder):
    counts = None
    for name in DOMAINS:
        one = star.row_counts(star_of(spark, folder, name)).select(F.lit(name).alias("domain"), "*")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("surrogate_keys")
def _(spark, folder):
    names = table(spark, folder, "part").select("p_brand", "p_type").distinct()
    return with_surrogate_keys(names, ("p_brand", "p_type"), "part_key", base=1000, buckets=BUCKETS)


@query("date_dimension")
def _(spark, folder):
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return _plain(star.date_members(days, "day"))


@query("date_parts")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("date").alias("d"))
    return _plain(events.select("event_id", *date_parts(F.col("d"))))


@query("calendar")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    return _plain(calendar(F.min("o_orderdate"), F.max("o_orderdate"), orders))


@query("calendar_use")
def _(spark, folder):
    """Orders per calendar month, months without orders included."""
    orders = table(spark, folder, "orders")
    days = calendar(F.trunc(F.min("o_orderdate"), "year"), F.last_day(F.max("o_orderdate")), orders)
    keyed = orders.select(date_key(F.col("o_orderdate").cast("date")).alias("_key"))
    joined = days.join(keyed, days["date_key"] == keyed["_key"], "left")
    return joined.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count("_key").alias("orders"), F.count_if(F.col("is_weekend") & F.col("_key").isNotNull()).alias("on_weekends")
    )


# ---- single joins ---------------------------------------------------------------------


@query("join_required")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, folder, "customer").where("c_acctbal > 0")
    return with_lookup(orders, customer, "c_mktsegment", ["c_custkey"], required=True)


@query("join_optional")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, folder, "customer").where("c_acctbal > 0")
    return with_lookup(orders, customer, "c_mktsegment", ["c_custkey"])


@query("join_null_safe")
def _(spark, folder):
    rows = silver_rows(spark, folder, "education")
    places = rows.groupBy("address", "city", "state").agg(F.min("_bronze_id").alias("place_id"))
    return with_lookup(
        rows.select("_bronze_id", "address", "city", "state"), places, "place_id", ["address", "city", "state"], null_safe=True
    )


@query("join_computed_key")
def _(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", date_key(F.col("o_orderdate").cast("date")).cast("bigint").alias("date_key")
    )
    days = table(spark, folder, "events").select(F.add_months(F.col("ts").cast("date"), -60).alias("d")).distinct()
    days = days.select(date_key(F.col("d")).cast("bigint").alias("date_key"), F.date_format("d", "EEEE").alias("day_name"))
    return with_lookup(orders, days, "day_name", ["date_key"])


@query("anti_join")
def _(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return absent_from(parts, table(spark, folder, "lineitem").where("l_quantity > 45"), ["l_partkey"])


@query("anti_join_null_safe")
def _(spark, folder):
    rows = silver_rows(spark, folder, "medical").select("address", "city", "state").distinct()
    known = rows.where("address IS NULL OR city = 'Ranchi'")
    return absent_from(rows, known, ["address", "city", "state"], null_safe=True)


@query("anti_join_required")
def _(spark, folder):
    rows = silver_rows(spark, folder, "medical").where("doctor_name IS NOT NULL")
    known = rows.where("blood_group = 'A+'").select("doctor_name").distinct()
    return absent_from(rows.select("doctor_name", "diagnosis").distinct(), known, ["doctor_name"])


@query("semi_join")
def _(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return present_in(customer, table(spark, folder, "orders").where("o_orderstatus = 'P'"), ["o_custkey"])


@query("exists_column")
def _(spark, folder):
    return spark.sql(
        """
        SELECT c.c_custkey,
               EXISTS (SELECT 1 FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey
                       WHERE s.s_nationkey = c.c_nationkey AND s.s_acctbal > 5000) AS has_rich_supplier
        FROM {customer} c
        """,
        **{name: table(spark, folder, name) for name in ("supplier", "nation", "customer")},
    )


@query("multiway_join")
def _(spark, folder):
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


@query("distinct_rows")
def _(spark, folder):
    return silver_rows(spark, folder, "marketing").select("address", "city", "state").distinct()


@query("ordered_rows")
def _(spark, folder):
    """The ten dearest orders per status, in order."""
    from pyspark.sql import Window

    best = Window.partitionBy("o_orderstatus").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = table(spark, folder, "orders").withColumn("place", F.row_number().over(best).cast("bigint"))
    rows = ranked.where("place <= 10").select("o_orderstatus", "place", "o_orderkey", "o_totalprice")
    return rows.orderBy("o_orderstatus", "place")


@query("first_rows")
def _(spark, folder):
    return table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select(
        "o_orderkey", "o_totalprice"
    ).limit(25)


@query("set_difference")
def _(spark, folder):
    from veilwork.operators.checks import unknown_values

    sold = table(spark, folder, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 48").select("l_partkey")
    return unknown_values(table(spark, folder, "part"), "p_partkey", sold)


@query("aligned_columns")
def _(spark, folder):
    """Two feature sets of the same documents side by side, by key."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, folder, "labels"), "doc_id").select("doc_id", "n_chars", "quality", "toxic")
