"""Ranks inside large groups without gathering any group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 60


def with_group_rank(
    rows: DataFrame, group: str, order: Column, tie: str, buckets: int = 4096
) -> DataFrame:
    """Add `group_rank` (1..n by `order`, then `tie`) and `group_size` to every row.

    `order` is a hash in [0, 2^60). Rows are numbered inside (group, hash range), which
    splits even a group that holds most of the data, and the sizes of the earlier ranges
    are added. The size table has at most groups x buckets rows. `group` needs few
    values, as class labels have.
    """
    width = (1 << HASH_BITS) // buckets
    marked = rows.withColumn("_order", order).withColumn(
        "_range", F.floor(F.col("_order") / F.lit(width)).cast("int")
    )
    sizes = marked.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_g",
        "_r",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_g")).alias("group_size"),
    )
    inside = Window.partitionBy(group, "_range").orderBy("_order", tie)
    numbered = marked.withColumn("_i", F.row_number().over(inside))
    joined = numbered.join(
        offsets, numbered[group].eqNullSafe(offsets["_g"]) & (numbered["_range"] == offsets["_r"])
    )
    return joined.withColumn("group_rank", F.col("_before") + F.col("_i")).drop(
        "_order", "_range", "_i", "_g", "_r", "_before"
    )


def stratified_split(
    rows: DataFrame, label: str, order: Column, tie: str, fraction: float = 0.2
) -> DataFrame:
    """Add `is_test`: the first ceil(fraction * n) rows of each class in hash order."""
    ranked = with_group_rank(rows, label, order, tie)
    cut = F.ceil(F.lit(fraction).cast("decimal(10,6)") * F.col("group_size"))
    return ranked.withColumn("is_test", F.col("group_rank") <= cut).drop("group_rank", "group_size")
