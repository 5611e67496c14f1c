"""First-wins deduplication and normalized-row signatures."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilwork.functions.cleaners import comparable


def first_per_key(rows: DataFrame, key: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The first row of every key.

    The filter on the row number becomes a group limit that runs before the shuffle, so
    at most one row per key and input partition travels, however often a key repeats.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_ids(rows: DataFrame, key: str, row_id: str) -> DataFrame:
    """(key, row id) of the first row of each key: an aggregate, combined before the shuffle."""
    return rows.groupBy(key).agg(F.min(row_id).alias(row_id))


def signature(df: DataFrame, columns: Iterable[str]) -> Column:
    """SHA-256 over the normalized values; lengths are included, so values cannot run together."""
    types = dict(df.dtypes)
    texts = F.array(*[comparable(F.col(name), types[name]) for name in columns])
    sized = F.transform(texts, lambda t: F.concat_ws(":", F.length(t), t))
    return F.sha2(F.concat_ws(":", sized), 256)


def duplicate_groups(df: DataFrame, columns: Iterable[str], row_id: str) -> DataFrame:
    """(signature, copies, first id) of the normalized rows that occur more than once."""
    signed = df.select(signature(df, columns).alias("signature"), F.col(row_id))
    return (
        signed.groupBy("signature")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(row_id).alias("first_id"))
        .where("copies > 1")
    )


def absent_signatures(df: DataFrame, columns: Iterable[str], known: DataFrame) -> DataFrame:
    """Rows whose normalized signature is neither in `known` nor on an earlier row of `df`."""
    columns = list(columns)
    signed = df.withColumn("_sig", signature(df, columns))
    seen = known.select(signature(known, columns).alias("_seen"))
    once = first_per_key(signed, ["_sig"], ["_bronze_id"])
    return once.join(seen, F.col("_sig") == F.col("_seen"), "left_anti").drop("_sig")
