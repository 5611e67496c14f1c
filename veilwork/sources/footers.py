"""Row and null counts from the footers of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.session import scratch_path
from veilwork.sources.tables import TableStore

# Readers that push aggregates down are those of the second data source interface.
PUSHED = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
COUNTS_SCHEMA = "table_name string, column_name string, records_scanned bigint, non_null_records bigint"


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers counts from footers; the given one stays as it is."""
    session = spark.newSession()
    for key, value in PUSHED.items():
        session.conf.set(key, value)
    return session


def footer_counts(session: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row: `_all` and `_v_<column>` for each column. No column is read, whatever the table's size."""
    rows = session.read.schema(schema).parquet(path)
    return rows.agg(F.count(F.lit(1)).alias("_all"), *[F.count(F.col(f"`{c}`")).alias(f"_v_{c}") for c in schema.names])


def stored_counts(store: TableStore, tables: dict[str, T.StructType]) -> DataFrame:
    """(table_name, column_name, records_scanned, non_null_records) of stored tables.

    A table that is not there yet has zeros. Counts are per file footer, so the cost grows with
    the number of files only.
    """
    session = counting_session(store.spark)
    out = []
    for name, schema in tables.items():
        if not store.exists(name):
            out.append(session.createDataFrame([(name, c, 0, 0) for c in schema.names], COUNTS_SCHEMA))
            continue
        totals = footer_counts(session, store.path(name), schema)
        long = totals.unpivot("_all", [F.col(f"`_v_{c}`") for c in schema.names], "column_name", "non_null_records")
        out.append(long.select(F.lit(name).alias("table_name"), F.substring("column_name", 4, 1 << 20).alias("column_name"),
                               F.col("_all").alias("records_scanned"), "non_null_records"))
    path = scratch_path(store.spark, "footers")
    for part in out:
        part.coalesce(1).write.mode("append").parquet(path)
    return store.spark.read.schema(COUNTS_SCHEMA).parquet(path)
