"""What readers of the PII catalog ask for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.functions.masks import MASKED_TYPES, TECHNIQUES
from veilwork.functions.patterns import domain_of_schema, ratio


def pii_catalog(fact: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """One row per scanned column: where it is, what it holds, how that was found, whether it is masked."""
    rows = (
        fact.join(gold["dim_source_schema"].drop("description"), "source_schema_key")
        .join(gold["dim_table"].select("table_key", "table_name"), "table_key")
        .join(gold["dim_column"].select("column_key", "column_name"), "column_key")
        .join(gold["dim_pii_type"].drop("description"), "pii_type_key")
        .join(gold["dim_sensitivity"].drop("description"), "sensitivity_key")
    )
    return rows.select(
        domain_of_schema(F.col("schema_name")).alias("domain"),
        "schema_name",
        "table_name",
        "column_name",
        "pii_type",
        "sensitivity_level",
        "detection_method",
        F.col("final_confidence").alias("confidence"),
        "pii_detected",
        F.when(F.col("masking_enabled"), "MASKED").otherwise("NOT_MASKED").alias("masking_status"),
        "masking_technique",
        "records_scanned",
        "pii_records_detected",
    )


def apply_masking_policy(catalog: DataFrame, enabled_types: Iterable[str] = MASKED_TYPES) -> DataFrame:
    """Mark the columns of the given types as masked, with the technique used.

    The default is what the role views mask.
    """
    on = F.col("pii_type").isin(*enabled_types)
    names = F.create_map(*[F.lit(x) for pair in TECHNIQUES.items() for x in pair])
    return catalog.withColumn(
        "masking_status", F.when(on, "MASKED").otherwise(F.col("masking_status"))
    ).withColumn(
        "masking_technique", F.when(on, names[F.col("pii_type")]).otherwise(F.col("masking_technique"))
    )


def pii_inventory(catalog: DataFrame) -> DataFrame:
    """PII columns in total, by domain, by table, by column and by type, in one aggregate."""
    found = catalog.where("pii_detected")
    return found.sparkSession.sql(
        """
        SELECT CASE WHEN grouping(pii_type) = 0 THEN 'type'
                    WHEN grouping(column_name) = 0 THEN 'column'
                    WHEN grouping(table_name) = 0 THEN 'table'
                    WHEN grouping(domain) = 0 THEN 'domain'
                    ELSE 'total' END AS level,
               domain, table_name, column_name, pii_type,
               count(*) AS pii_columns,
               sum(pii_records_detected) AS pii_records
        FROM {found}
        GROUP BY GROUPING SETS ((), (domain), (domain, table_name),
                                (domain, table_name, column_name), (pii_type))
        """,
        found=found,
    )


def sensitivity_by(catalog: DataFrame, column: str) -> DataFrame:
    """Columns per sensitivity level, pivoted, for each value of `column`."""
    return (
        catalog.groupBy(column)
        .pivot("sensitivity_level", ["HIGH", "MEDIUM", "LOW"])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def sensitivity_distribution(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("sensitivity_level").agg(
        F.count(F.lit(1)).alias("columns"), F.count_if("pii_detected").alias("pii_columns")
    )


def masking_coverage(catalog: DataFrame) -> DataFrame:
    """Masked against sensitive columns, per domain."""
    sensitive = F.col("sensitivity_level").isin("HIGH", "MEDIUM")
    masked = sensitive & (F.col("masking_status") == "MASKED")
    counted = catalog.groupBy("domain").agg(
        F.count_if(sensitive).alias("sensitive_columns"), F.count_if(masked).alias("masked_columns")
    )
    return counted.withColumn("coverage", ratio(F.col("masked_columns"), F.col("sensitive_columns")))


AUDIT_KEYS = ("role", "resource", "action", "result")


def audit_report(log: DataFrame, every: str = "1 day") -> DataFrame:
    """Accesses per time window, role, resource, action and result."""
    return (
        log.groupBy(F.window("ts", every), *AUDIT_KEYS)
        .agg(F.count(F.lit(1)).alias("accesses"), F.count_distinct("user_id").alias("users"))
        .select(F.col("window.start").alias("window_start"), *AUDIT_KEYS, "accesses", "users")
    )


def audit_by_user(log: DataFrame) -> DataFrame:
    """Per user: accesses, denials, first and last access."""
    return log.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("accesses"),
        F.count_if(F.col("result") == "DENIED").alias("denied"),
        F.min("ts").alias("first_access"),
        F.max("ts").alias("last_access"),
    )
