"""Silver -> star schemas: dimensions that only gain members, facts that only gain rows."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.dates import date_key, date_parts
from veilwork.operators.joins import absent_from, present_in, with_lookup
from veilwork.operators.keys import KEY_BUCKETS, max_key, with_surrogate_keys
from veilwork.plans.silver import silver_table
from veilwork.schemas import DOMAINS, Dim, Domain
from veilwork.session import materialize
from veilwork.sources.tables import RUN, Keyed, TableStore

SIDE_BY_SIDE = 4  # dimensions loaded at the same time
MATCH = "_match"
RUNS = "star/_runs"
RUNS_SCHEMA = "run_id string, domain string, silver_run string"


def date_members(source: DataFrame, column: str, dim: DataFrame | None = None) -> DataFrame:
    """Date-dimension rows of the distinct dates in `column` that `dim` lacks."""
    days = source.select(F.col(column).alias("_day")).where("_day IS NOT NULL").distinct()
    rows = days.select(*date_parts(F.col("_day")))
    return rows if dim is None else absent_from(rows, dim, ["date_key"])


def new_members(source: DataFrame, spec: Dim, dim: DataFrame | None = None) -> DataFrame:
    """Distinct attribute rows of `source` whose match columns `dim` lacks; no keys yet."""
    rows = source.select(*spec.attrs)
    for c in spec.required:
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.distinct()
    return rows if dim is None else absent_from(rows, dim, spec.match, spec.null_safe_load)


def dimension_rows(
    source: DataFrame, spec: Dim, dim: DataFrame | None = None, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """The rows to append to a dimension, with keys above those in use."""
    if spec.is_date:
        return date_members(source, spec.attrs[0], dim)
    base = max_key(dim, spec.key) if dim is not None else 0
    return with_surrogate_keys(new_members(source, spec, dim), spec.attrs, spec.key, base, buckets)


def fact_rows(
    source: DataFrame, domain: Domain, dims: dict[str, DataFrame], fact: DataFrame | None = None
) -> DataFrame:
    """The fact rows of `source` that `fact` lacks, with the keys of their dimension members."""
    if fact is not None:
        source = absent_from(source, fact, ["_bronze_id"])
    keys = []
    rows = source
    for spec in domain.dims:
        key = spec.fact_key or spec.key
        if spec.is_date:
            # The date's own key is computed; the join only tells whether the member exists.
            rows = rows.withColumn("date_key", date_key(F.col(spec.attrs[0])))
            rows = with_lookup(rows, dims[spec.name], "date_key", ["date_key"], "_found").drop("date_key")
            rows = rows.withColumnRenamed("_found", key)
        else:
            rows = with_lookup(
                rows, dims[spec.name], spec.key, spec.lookup_columns, key,
                spec.null_safe_lookup, required=spec.is_person,
            )
        keys.append(key)
    measures = [F.expr(e).alias(name) for name, e in domain.fact.measures]
    return rows.select(*keys, *measures, "_bronze_id")


def dim_schema(domain: Domain, spec: Dim) -> T.StructType:
    if spec.is_date:
        return T.StructType.fromDDL(
            "date_key int, full_date date, day int, day_name string, week int, month int, "
            "month_name string, quarter int, year int, is_weekend boolean"
        )
    types = {f.name: f.dtype for f in domain.fields} | {"city": "string", "state": "string"}
    columns = [f"{spec.key} bigint", *[f"{c} {types[c]}" for c in spec.attrs]]
    return T.StructType.fromDDL(", ".join(columns))


def fact_schema(domain: Domain) -> T.StructType:
    types = {f.name: f.dtype for f in domain.fields}
    columns = [
        f"{spec.fact_key or spec.key} {'int' if spec.is_date else 'bigint'}" for spec in domain.dims
    ]
    columns += [f"{name} {types.get(e, 'int')}" for name, e in domain.fact.measures]
    return T.StructType.fromDDL(", ".join([*columns, "_bronze_id bigint"]))


def match_hash(columns: tuple[str, ...]) -> Column:
    """A fingerprint of the columns that decide on a member, for storage; equal ones agree, nulls included."""
    return F.xxhash64(*[F.col(c) for c in columns])


def dim_table(domain: Domain, spec: Dim) -> Keyed:
    """A dimension by buckets of its match columns' fingerprint."""
    schema = T.StructType([*dim_schema(domain, spec), T.StructField(MATCH, T.LongType())])
    return Keyed(f"star_{domain.name}/{spec.name}", schema, (MATCH,))


def fact_table(domain: Domain) -> Keyed:
    """The fact by buckets of the Bronze row id."""
    return Keyed(f"star_{domain.name}/{domain.fact.name}", fact_schema(domain), ("_bronze_id",))


def known_members(stored: DataFrame, members: DataFrame, spec: Dim, buckets: int) -> DataFrame:
    """The stored rows that members of a batch may agree with.

    The dimension is read in place; what is shuffled and what comes out grow with the batch.
    """
    wanted = members.select(match_hash(stored_match(spec)).alias(MATCH)).distinct()
    return present_in(stored, wanted.repartition(buckets, MATCH), [MATCH]).drop(MATCH, RUN)


def stored_match(spec: Dim) -> tuple[str, ...]:
    return ("date_key",) if spec.is_date else spec.match


def star_tables(store: TableStore, domain: Domain) -> dict[str, DataFrame]:
    schema = f"star_{domain.name}"
    tables = {d.name: store.read(f"{schema}/{d.name}", dim_schema(domain, d)) for d in domain.dims}
    tables[domain.fact.name] = store.read(f"{schema}/{domain.fact.name}", fact_schema(domain))
    return tables


def fresh_rows(store: TableStore, domain: Domain, done: DataFrame, rescan: bool) -> DataFrame:
    """Silver rows without a fact. Only Silver runs that no finished star run has read are looked
    at, by partition, and the fact is read in place."""
    silver = store.keyed(silver_table(domain))
    if not rescan:
        # One short id per run.
        loaded = {r["silver_run"] for r in done.select("silver_run").collect()}
        silver = silver.where(F.col(RUN).isin(sorted(store.runs(silver_table(domain)) - loaded)))
    return absent_from(silver, store.keyed(fact_table(domain)), ["_bronze_id"], buckets=store.buckets)


def _settle_members(
    store: TableStore, domain: Domain, spec: Dim, fresh: DataFrame, run: str, buckets: int
) -> tuple[DataFrame, int]:
    """Add a batch's new members to a dimension; returns the members the batch may use, and how many are new."""
    table = dim_table(domain, spec)
    stored = store.keyed(table)
    if spec.is_date:
        members = date_members(fresh, spec.attrs[0])
    else:
        members = fresh.select(*spec.attrs).distinct()
    known = materialize(known_members(stored, members, spec, store.buckets), spec.name)
    if spec.is_date:
        new = date_members(fresh, spec.attrs[0], known)
    else:
        new = with_surrogate_keys(
            new_members(fresh, spec, known), spec.attrs, spec.key, max_key(stored, spec.key), buckets
        )
    new = materialize(new, spec.name)
    store.append_keyed(table, new.withColumn(MATCH, match_hash(stored_match(spec))), run)
    return known.unionByName(new.select(*known.columns)), new.count()


def load_star(
    store: TableStore, name: str, buckets: int = KEY_BUCKETS, rescan: bool = False
) -> dict[str, int]:
    """Bring one star schema up to date; returns the rows added per table.

    Only Silver rows without a fact are looked at: the others had their members loaded
    before their fact. Dimensions are written before the fact, so keys are settled; after
    a failure the load can simply be run again, and `rescan` looks at all Silver runs.

    Stored tables are never shuffled: of each dimension, the members that the batch may agree
    with are picked bucket by bucket, and new members and the fact's keys are found among those.
    """
    domain = DOMAINS[name]
    run = uuid.uuid4().hex
    runs = set(store.runs(silver_table(domain)))
    done = store.read(RUNS, RUNS_SCHEMA).where(F.col("domain") == name)
    fresh = materialize(fresh_rows(store, domain, done, rescan), f"fresh-{name}")
    added = {table: 0 for table in (*[d.name for d in domain.dims], domain.fact.name)}
    if not fresh.isEmpty():
        # Dimensions are independent of one another.
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            settled = list(pool.map(lambda spec: _settle_members(store, domain, spec, fresh, run, buckets), domain.dims))
        dims = {spec.name: members for spec, (members, _) in zip(domain.dims, settled, strict=True)}
        added |= {spec.name: n for spec, (_, n) in zip(domain.dims, settled, strict=True)}
        facts = materialize(fact_rows(fresh, domain, dims), domain.fact.name)
        added[domain.fact.name], expected = facts.count(), fresh.count()
        if added[domain.fact.name] != expected:
            raise RuntimeError(f"star_{name}: {added[domain.fact.name]} fact rows for {expected} Silver rows")
        store.append_keyed(fact_table(domain), facts, run)
    loaded = {r["silver_run"] for r in done.select("silver_run").collect()}
    log = [(run, name, r) for r in sorted(runs - loaded)]
    if log:
        store.append(RUNS, store.spark.createDataFrame(log, RUNS_SCHEMA).coalesce(1))
    return added


def load_all_stars(store: TableStore) -> dict[str, dict[str, int]]:
    return {name: load_star(store, name) for name in DOMAINS}


def star_in_memory(silver: DataFrame, domain: Domain, buckets: int = KEY_BUCKETS) -> dict[str, DataFrame]:
    """Dimensions and fact of a first load, as lazy frames."""
    tables = {d.name: dimension_rows(silver, d, buckets=buckets) for d in domain.dims}
    tables[domain.fact.name] = fact_rows(silver, domain, tables)
    return tables


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
