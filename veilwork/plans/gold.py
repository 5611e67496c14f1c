"""Gold: the catalog of warehouse columns, the taxonomy, and the PII scan fact."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions.dates import date_key, date_parts
from veilwork.functions.patterns import domain_of_schema, sample_features, semantic_text, table_type
from veilwork.operators.joins import insert_ignore
from veilwork.operators.keys import max_key, with_surrogate_keys
from veilwork.operators.profile import column_parts, merged_parts
from veilwork.schemas import PII_TYPES, SENSITIVITY_LEVELS, SENSITIVITY_POLICY
from veilwork.session import materialize
from veilwork.sources.tables import TableStore

log = logging.getLogger(__name__)

# Tables to scan: (schema, table) -> rows.
Warehouse = dict[tuple[str, str], DataFrame]

CATALOG_BUCKETS = 64
FAULTS = "gold/scan_faults"
FAULTS_SCHEMA = (
    "scan_id string, scan_timestamp timestamp, schema_name string, table_name string, column_name string, error string"
)
CALENDAR = (dt.date(2020, 1, 1), dt.date(2035, 12, 31))

SCHEMAS = {
    "dim_source_schema": "source_schema_key bigint, schema_name string, description string",
    "dim_table": "table_key bigint, source_schema_key bigint, table_name string, description string",
    "dim_column": "column_key bigint, table_key bigint, column_name string, data_type string, "
    "nullable boolean, ordinal_position int",
    "dim_pii_type": "pii_type_key bigint, pii_type string, description string",
    "dim_sensitivity": "sensitivity_key bigint, sensitivity_level string, description string",
    "dim_date": "date_key int, full_date date, day int, month int, month_name string, "
    "quarter int, year int, is_weekend boolean",
    "fact_pii_scan": "source_schema_key bigint, table_key bigint, column_key bigint, "
    "pii_type_key bigint, sensitivity_key bigint, date_key int, scan_timestamp timestamp, "
    "pii_detected boolean, ml_probability double, final_confidence double, model_version string, "
    "masking_enabled boolean, masking_technique string, records_scanned bigint, "
    "pii_records_detected bigint, detection_method string, scan_id string",
}

# ---- catalog --------------------------------------------------------------------------


def catalog_columns(spark: SparkSession, tables: Warehouse) -> DataFrame:
    """(schema_name, table_name, column_name, data_type, nullable, ordinal_position); no data is read."""
    rows = [
        (schema, table, f.name, f.dataType.simpleString(), f.nullable, i)
        for (schema, table), df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "schema_name string, table_name string, column_name string, data_type string, "
        "nullable boolean, ordinal_position int",
    )


def catalog_tables(columns: DataFrame, schemas: list[str] | None = None) -> DataFrame:
    """(schema_name, table_name), limited to the listed schemas."""
    tables = columns.select("schema_name", "table_name").distinct()
    return tables if schemas is None else tables.where(F.col("schema_name").isin(schemas))


def constraint_rows(spark: SparkSession, constraints: list[tuple[str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(
        constraints, "schema_name string, table_name string, column_name string, constraint_type string"
    )


def column_inventory(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """Catalog columns with table type and key flags, ordered."""
    on = ["schema_name", "table_name", "column_name"]
    keys = constraints.groupBy(*on).agg(
        F.bool_or(F.col("constraint_type") == "PRIMARY KEY").alias("is_primary_key"),
        F.bool_or(F.col("constraint_type") == "FOREIGN KEY").alias("is_foreign_key"),
    )
    return (
        columns.withColumn("table_type", table_type(F.col("table_name")))
        .join(keys, on, "left")
        .na.fill(False, ["is_primary_key", "is_foreign_key"])
        .orderBy("schema_name", "table_name", "ordinal_position")
    )


# ---- seeds ----------------------------------------------------------------------------


def pii_type_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PII_TYPES.items()), "pii_type string, description string")


def sensitivity_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SENSITIVITY_LEVELS.items()), "sensitivity_level string, description string"
    )


def policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SENSITIVITY_POLICY.items()), "pii_type string, sensitivity_level string"
    )


def with_sensitivity(rows: DataFrame) -> DataFrame:
    """Add `sensitivity_level` by PII type; a type without a policy is an error."""
    joined = rows.join(policy(rows.sparkSession), "pii_type", "left")
    fault = F.raise_error(F.concat(F.lit("no sensitivity policy for "), F.col("pii_type")))
    checked = F.coalesce("sensitivity_level", fault.cast("string"))
    return joined.withColumn("sensitivity_level", checked)


def calendar(first: Column, last: Column, source: DataFrame) -> DataFrame:
    """One row per day between two aggregates over `source`."""
    span = source.agg(first.cast("date").alias("a"), last.cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("_day"))
    return days.select(*date_parts(F.col("_day"), with_week=False))


def gold_calendar(spark: SparkSession) -> DataFrame:
    return calendar(F.lit(CALENDAR[0]), F.lit(CALENDAR[1]), spark.range(1))


# ---- scan -----------------------------------------------------------------------------


def scan_inputs(tables: Warehouse, row_hashes: dict[tuple[str, str], Column] | None = None) -> DataFrame:
    """(schema_name, table_name, column_name, records_scanned, non_null_records, samples).

    One pass per table yields counts and samples, and all tables are read by one job: each
    task gives a few rows per column, which are merged by one shuffle. Nothing is collected.
    Columns of an empty table have zeros and no samples.
    """
    row_hashes = row_hashes or {}
    spark = next(iter(tables.values())).sparkSession
    by = ["schema_name", "table_name", "column_name"]
    parts = None
    for (schema, table), df in tables.items():
        one = column_parts(df, row_hash=row_hashes.get((schema, table)))
        one = one.select(F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "*")
        parts = one if parts is None else parts.unionByName(one)
    # A part of no rows for every column, so that empty tables are there.
    names = [(s, t, c, 0, 0, []) for (s, t), df in tables.items() for c in df.columns]
    return merged_parts(parts.unionByName(spark.createDataFrame(names, parts.schema)), by)


def column_features(inputs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Inventory columns with their counts, samples, describing sentence and 18 sample features."""
    joined = inventory.join(inputs, ["schema_name", "table_name", "column_name"])
    described = joined.withColumn("domain", domain_of_schema(F.col("schema_name"))).withColumn(
        "semantic_text",
        semantic_text(
            F.col("domain"), F.col("table_name"), F.col("table_type"),
            F.col("column_name"), F.col("data_type"), F.col("samples"),
        ),
    )
    return described.select("*", *sample_features(F.col("samples")))


def scan_outcome(predictions: DataFrame) -> DataFrame:
    """Add pii_detected and pii_records_detected: all non-null values of a PII column."""
    detected = F.col("pii_type") != "NON_PII"
    return predictions.withColumn("pii_detected", detected).withColumn(
        "pii_records_detected", F.when(detected, F.col("non_null_records")).otherwise(F.lit(0))
    )


def resolve_keys(predictions: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """Add the five Gold keys of every prediction; an unresolvable one is an error."""
    rows = with_sensitivity(predictions)
    steps = (
        ("dim_source_schema", ["schema_name"], "source_schema_key"),
        ("dim_table", ["source_schema_key", "table_name"], "table_key"),
        ("dim_column", ["table_key", "column_name"], "column_key"),
        ("dim_pii_type", ["pii_type"], "pii_type_key"),
        ("dim_sensitivity", ["sensitivity_level"], "sensitivity_key"),
    )
    for table, on, key in steps:
        rows = rows.join(gold[table].select(*on, key), on, "left")
        where = F.concat_ws(".", "schema_name", "table_name", "column_name")
        fault = F.raise_error(F.concat(F.lit(f"no {key} for "), where)).cast("bigint")
        rows = rows.withColumn(key, F.coalesce(key, fault))
    return rows


def scan_fact(resolved: DataFrame, at: dt.datetime, model_version: str, scan_id: str) -> DataFrame:
    stamp = F.lit(at).cast("timestamp")
    have = set(resolved.columns)
    added = {
        "date_key": date_key(stamp.cast("date")),
        "scan_timestamp": stamp,
        "model_version": F.lit(model_version),
        "masking_enabled": F.lit(False),
        "masking_technique": F.lit(None).cast("string"),
        "scan_id": F.lit(scan_id),
    }
    if "detection_method" not in have:
        added["detection_method"] = F.lit("ML")
    if "ml_probability" not in have:
        added["ml_probability"] = F.col("final_confidence")
    order = [c.split()[0] for c in SCHEMAS["fact_pii_scan"].split(", ")]
    return resolved.withColumns(added).select(*order)


def latest_scan(fact: DataFrame) -> DataFrame:
    """The newest scan row of every column: an aggregate, as history has many rows per column."""
    newest = fact.groupBy("column_key").agg(
        F.max(F.struct("scan_timestamp", "scan_id")).alias("_newest")
    )
    newest = newest.select(
        F.col("column_key").alias("_column"), "_newest.scan_timestamp", F.col("_newest.scan_id").alias("_scan")
    ).drop("scan_timestamp")
    return fact.join(
        newest, (fact["column_key"] == newest["_column"]) & (fact["scan_id"] == newest["_scan"]), "left_semi"
    )


# ---- tables ---------------------------------------------------------------------------


def read_gold(store: TableStore) -> dict[str, DataFrame]:
    return {name: store.read(f"gold/{name}", ddl) for name, ddl in SCHEMAS.items()}


def _new_rows(table: str, rows: DataFrame, known: DataFrame | None, unique: list[str], key: str | None) -> DataFrame:
    new = insert_ignore(rows, known, unique)
    if key:
        base = 0 if known is None else max_key(known, key)
        new = with_surrogate_keys(new, tuple(unique), key, base, CATALOG_BUCKETS)
    return new.select(*[c.split()[0] for c in SCHEMAS[table].split(", ")])


def catalog_additions(
    columns: DataFrame, known: dict[str, DataFrame], settle=lambda table, rows: rows
) -> dict[str, DataFrame]:
    """Rows that the catalog and taxonomy dimensions lack, parents before children.

    `settle` gets each table's new rows and returns the whole table as later steps are to
    see it: the rows themselves, or what was read back after appending them.
    """
    spark = columns.sparkSession
    name = F.col("schema_name")
    out: dict[str, DataFrame] = {}

    def add(table, rows, unique, key):
        out[table] = settle(table, _new_rows(table, rows, known.get(table), unique, key))

    schemas = columns.select("schema_name").distinct()
    described = F.concat(domain_of_schema(name), F.lit(" domain star schema"))
    add("dim_source_schema", schemas.withColumn("description", described), ["schema_name"], "source_schema_key")
    schema_keys = out["dim_source_schema"].drop("description")
    found = catalog_tables(columns).join(schema_keys, "schema_name")
    found = found.withColumn("description", F.concat(F.lit("Warehouse table in "), name))
    add("dim_table", found, ["source_schema_key", "table_name"], "table_key")
    keyed = columns.join(schema_keys, "schema_name").join(
        out["dim_table"].drop("description"), ["source_schema_key", "table_name"]
    )
    add("dim_column", keyed, ["table_key", "column_name"], "column_key")
    add("dim_pii_type", pii_type_seed(spark), ["pii_type"], "pii_type_key")
    add("dim_sensitivity", sensitivity_seed(spark), ["sensitivity_level"], "sensitivity_key")
    return out


def populate_catalog(store: TableStore, tables: Warehouse) -> None:
    """Add schemas, tables, columns, taxonomy and calendar rows that Gold lacks."""

    def settle(table, rows):
        store.append(f"gold/{table}", rows)
        return store.read(f"gold/{table}", SCHEMAS[table])

    known = read_gold(store)
    catalog_additions(catalog_columns(store.spark, tables), known, settle)
    dates = _new_rows("dim_date", gold_calendar(store.spark), known["dim_date"], ["date_key"], None)
    store.append("gold/dim_date", dates)


def record_scan(
    store: TableStore, predictions: DataFrame, at: dt.datetime, model_version: str, scan_id: str
) -> None:
    """Append one full set of scan rows."""
    resolved = resolve_keys(scan_outcome(predictions), read_gold(store))
    store.append("gold/fact_pii_scan", scan_fact(resolved, at, model_version, scan_id))


def scan_isolated(
    tables: Warehouse, features_of: Callable[[Warehouse], DataFrame], faults: list[tuple[str, str, str, str]]
) -> list[DataFrame]:
    """Settled features of all columns that can be read; (schema, table, column, error) of the others.

    All tables are tried together. A part that fails is halved, by tables and then by columns,
    until the columns at fault are alone; so one bad column costs about two scans for each
    halving, and a clean warehouse one scan.
    """
    try:
        return [materialize(features_of(tables), "scan")]
    except Exception as fault:  # the other columns are independent
        cells = [(name, c) for name, df in tables.items() for c in df.columns]
        if len(cells) == 1:
            ((schema, table), column) = cells[0]
            error = (str(fault).splitlines() or [type(fault).__name__])[0]
            log.warning("not scanned: %s.%s.%s: %s", schema, table, column, error)
            faults.append((schema, table, column, error))
            return []
    names = list(tables)
    out = []
    for half in (slice(None, (len(names) + 1) // 2), slice((len(names) + 1) // 2, None)):
        if len(names) > 1:
            part = {name: tables[name] for name in names[half]}
        else:
            df = tables[names[0]]
            middle = len(df.columns) // 2
            part = {names[0]: df.select(*[f"`{c}`" for c in (df.columns[:middle] if half.start is None else df.columns[middle:])])}
        out += scan_isolated(part, features_of, faults)
    return out


def run_scan(
    store: TableStore,
    tables: Warehouse,
    constraints: list[tuple[str, str, str, str]],
    classify,
    at: dt.datetime,
    model_version: str,
    scan_id: str,
) -> DataFrame:
    """Catalog, sample, classify and record every column; returns (status, columns).

    `classify` maps column features to `pii_type` and `final_confidence`. A column that
    cannot be read is counted as failed and entered in FAULTS, and the others go on. The
    rows of one scan are appended at once.
    """
    spark = store.spark
    populate_catalog(store, tables)
    inventory = column_inventory(catalog_columns(spark, tables), constraint_rows(spark, constraints))
    faults: list[tuple[str, str, str, str]] = []
    parts = scan_isolated(tables, lambda part: classify(column_features(scan_inputs(part), inventory)), faults)
    if parts:
        record_scan(store, reduce(DataFrame.unionByName, parts), at, model_version, scan_id)
    if faults:
        rows = [(scan_id, at, *fault) for fault in faults]  # one per column
        store.append(FAULTS, spark.createDataFrame(rows, FAULTS_SCHEMA).coalesce(1))
    done = sum(len(df.columns) for df in tables.values()) - len(faults)
    return spark.createDataFrame([("successful", done), ("failed", len(faults))], "status string, columns bigint")
