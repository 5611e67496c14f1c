"""Keys found in the data: unique columns and inclusion dependencies of any number of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.session import materialize

Name = tuple[str, str, str]  # schema, table, column
WORD = 62  # columns per number of a column set

# Columns are compared inside a class of types only.
_CLASSES = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "double", "timestamp_ntz": "timestamp"}


def column_names(tables: dict[tuple[str, str], DataFrame]) -> list[Name]:
    return [(*name, c) for name, df in tables.items() for c in df.columns]


def column_values(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(column, class, value, n): each distinct non-null value of each column, by the column's number.

    Equal values are counted before they move, so a value costs a row per column and task.
    """
    parts, number = [], 0
    for df in tables.values():
        kinds = dict(df.dtypes)
        cells = [
            F.struct(
                F.lit(number + i).alias("column"),
                F.lit(_CLASSES.get(kinds[c], kinds[c])).alias("class"),
                F.col(f"`{c}`").cast("string").alias("value"),
            )
            for i, c in enumerate(df.columns)
        ]
        number += len(cells)
        parts.append(df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where("value IS NOT NULL"))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("column", "class", "value").agg(F.count(F.lit(1)).alias("n"))


def uniqueness(values: DataFrame) -> DataFrame:
    """(column, values, distinct_values, repeated): repeated values are those on two rows or more."""
    return values.groupBy("column").agg(
        F.sum("n").alias("values"), F.count(F.lit(1)).alias("distinct_values"), F.count_if(F.col("n") > 1).alias("repeated")
    )


def _words(columns: int) -> list[str]:
    return [f"w{i}" for i in range(-(-columns // WORD))]


def column_sets(values: DataFrame, columns: int) -> DataFrame:
    """(class, value, w0, w1, ...): the set of columns that hold each value, as bits of numbers."""
    own = [
        F.when(F.floor(F.col("column") / WORD) == i, F.expr(f"shiftleft(1L, column % {WORD})")).otherwise(F.lit(0).cast("bigint")).alias(w)
        for i, w in enumerate(_words(columns))
    ]
    return values.select("class", "value", *own).groupBy("class", "value").agg(*[F.bit_or(w).alias(w) for w in _words(columns)])


def _has(column: int) -> Column:
    return F.expr(f"(shiftright(w{column // WORD}, {column % WORD}) & 1L) = 1")


def inclusions(values: DataFrame, columns: int) -> DataFrame:
    """(column, within): every pair of columns where all values of the first occur in the second.

    The columns that hold a value are a set; a column lies within all columns that are in every
    set it is part of, which is an intersection. Both steps are bit aggregates that combine
    before they shuffle. Columns without values are left out.
    """
    words = _words(columns)
    member = F.filter(F.array(*[F.when(_has(i), F.lit(i)) for i in range(columns)]), lambda x: x.isNotNull())
    sets = column_sets(values, columns).groupBy(*words).agg(F.count(F.lit(1)).alias("n"))
    common = sets.select(*words, F.explode(member).alias("column")).groupBy("column").agg(
        *[F.bit_and(w).alias(w) for w in words]
    )
    return common.select("column", F.explode(member).alias("within")).where("column <> within")


def check_constraints(
    tables: dict[tuple[str, str], DataFrame], primary: list[Name], foreign: list[tuple[Name, Name]]
) -> DataFrame:
    """One row per declared constraint, with the number of values that break it.

    (schema_name, table_name, column_name, constraint_type, ref_table, ref_column, violations):
    for a primary key the rows without a value and the repeated values, for a foreign key the
    distinct values that the referenced column lacks. All tables are read once.
    """
    wanted = {x for x in primary} | {x for pair in foreign for x in pair}
    used = {
        name: df.select(*[c for c in df.columns if (*name, c) in wanted])
        for name, df in tables.items()
        if any((*name, c) in wanted for c in df.columns)
    }
    names = column_names(used)
    place = {name: i for i, name in enumerate(names)}
    spark = next(iter(used.values())).sparkSession
    values = materialize(column_values(used), "values")
    rows = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(place[(*name, c)]).alias("column"), "rows")
        for name, df in used.items() for c in df.columns if (*name, c) in set(primary)
    ])
    known = uniqueness(values)
    keys = rows.join(known.withColumnRenamed("column", "_column"), F.col("column") == F.col("_column"), "left").select(
        "column", (F.col("rows") - F.coalesce("values", F.lit(0)) + F.coalesce("repeated", F.lit(0))).alias("violations")
    )
    sets = column_sets(values, len(names)).groupBy(*_words(len(names))).agg(F.count(F.lit(1)).alias("n"))
    broken = [
        F.sum(F.when(_has(place[a]) & ~_has(place[b]), F.col("n")).otherwise(0)).alias(f"_{i}")
        for i, (a, b) in enumerate(foreign)
    ]
    described = [(place[x], *x, "PRIMARY KEY", None, None, None) for x in primary]
    described += [(place[a], *a, "FOREIGN KEY", b[1], b[2], i) for i, (a, b) in enumerate(foreign)]
    listed = spark.createDataFrame(
        described, "column int, schema_name string, table_name string, column_name string, constraint_type string, "
        "ref_table string, ref_column string, number int"
    )
    counts = F.array(*[F.col(f"_{i}") for i in range(len(foreign))])
    missing = sets.agg(*broken).select(F.posexplode(counts).alias("_number", "missing")) if foreign else None
    out = listed.join(keys.withColumnRenamed("column", "_column"), (F.col("column") == F.col("_column")) & F.col("number").isNull(), "left")
    if missing is not None:
        out = out.join(missing, F.col("number") == F.col("_number"), "left")
    else:
        out = out.withColumn("missing", F.lit(None).cast("bigint"))
    return out.select(
        "schema_name", "table_name", "column_name", "constraint_type", "ref_table", "ref_column",
        F.coalesce("missing", "violations", F.lit(0)).cast("bigint").alias("violations"),
    )
