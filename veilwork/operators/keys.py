"""Surrogate keys without a global sort or a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 1024
_SEPARATOR = "\x1f"


def stable_hash(*columns: Column) -> Column:
    """A non-negative 60-bit hash that other engines can reproduce from MD5."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x1e")) for c in columns]
    digest = F.md5(F.concat_ws(_SEPARATOR, *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def with_surrogate_keys(
    members: DataFrame, natural: tuple[str, ...], key: str, base: int = 0, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Add unique keys above `base`, in a fixed order for the same members.

    `members` must be distinct on `natural`. Each member falls into a hash bucket, is
    numbered inside it, and gets key = base + (number - 1) * buckets + bucket + 1. That
    is unique without knowing any bucket's size, so there is no counting pass and no
    single-task window, and a retried task computes the same keys again. Keys have gaps,
    as database sequences do.
    """
    bucket = F.pmod(stable_hash(*[F.col(c) for c in natural]), F.lit(buckets))
    in_bucket = Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_first(c) for c in natural])
    number = F.row_number().over(in_bucket).cast("bigint")
    return (
        members.withColumn("_bucket", bucket)
        .withColumn(key, F.lit(base) + (number - 1) * buckets + F.col("_bucket") + 1)
        .drop("_bucket")
        .select(key, *members.columns)
    )


def max_key(table: DataFrame, key: str) -> int:
    """Highest key in use, 0 for an empty table."""
    return table.agg(F.max(key)).first()[0] or 0
