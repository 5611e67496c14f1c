"""Labelled example columns for training: read from CSV, or sampled from tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilwork.functions.text import strip
from veilwork.operators.checks import require_columns
from veilwork.operators.profile import default_row_hash, unpivot_text

COLUMNS = (
    "domain", "table_name", "table_type", "column_name", "data_type",
    "is_primary_key", "is_foreign_key", "sample_values", "label",
)


def prepare(raw: DataFrame) -> DataFrame:
    """Check the columns, drop rows without a label, trim labels."""
    rows = require_columns(raw, COLUMNS).na.drop(subset=["label"])
    return rows.withColumn("label", strip(F.col("label")))


def load(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return prepare(raw)


def sample_columns(
    df: DataFrame, columns: list[str], groups: int, row_hash: Column | None = None
) -> DataFrame:
    """(column_name, sample_group, sample_values): 2-5 values for each of `groups` groups per column.

    Rows are put into groups by hash. Only as many rows as the groups can use, several
    times over, are read past the scan.
    """
    row_hash = default_row_hash(df) if row_hash is None else row_hash
    rows = df.withColumn("_hash", row_hash)
    wanted = groups * 5 * 16
    size = df.count()
    if size > wanted:
        rows = rows.where(F.col("_hash") < int((1 << 60) * (wanted / size)))
    values = unpivot_text(rows, columns, ["_hash"]).where("value IS NOT NULL").distinct()
    values = values.withColumn("sample_group", F.pmod("_hash", F.lit(groups)))
    order = Window.partitionBy("column_name", "sample_group").orderBy(F.shiftright("_hash", 8), "value")
    take = F.lit(2) + F.pmod(F.col("sample_group"), F.lit(4))
    few = values.withColumn("_n", F.row_number().over(order)).where((F.col("_n") <= 5) & (F.col("_n") <= take))
    return few.groupBy("column_name", "sample_group").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("_n", "value"))), lambda s: strip(s["value"])), "|"
        ).alias("sample_values")
    )


def from_tables(
    tables: dict[tuple[str, str], DataFrame],
    labels: dict[tuple[str, str], str],
    inventory: DataFrame,
    groups: int = 12,
) -> DataFrame:
    """Training rows for the columns that `labels` ((table, column) -> type) knows."""
    parts = []
    for (schema, table), df in tables.items():
        known = {c: labels[table, c] for c in df.columns if (table, c) in labels}
        if not known:
            continue
        sampled = sample_columns(df.select(*known), list(known), groups)
        names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        parts.append(
            sampled.select(
                F.lit(schema).alias("schema_name"),
                F.lit(table).alias("table_name"),
                "column_name",
                "sample_group",
                "sample_values",
                names[F.col("column_name")].alias("label"),
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    facts = inventory.select(
        "schema_name", "table_name", "column_name", "table_type", "data_type", "is_primary_key", "is_foreign_key"
    )
    joined = rows.join(facts, ["schema_name", "table_name", "column_name"])
    return joined.withColumn("domain", F.initcap(F.replace("schema_name", F.lit("star_"), F.lit("")))).select(
        *COLUMNS, "schema_name", "sample_group"
    )
