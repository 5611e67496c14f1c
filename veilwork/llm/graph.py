"""Connected components by star contraction, in joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.session import materialize


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component) of every node in `edges`; a component is named by its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours, then
    its smaller ones, to its smallest neighbour. The number of rounds grows with the
    logarithm of the longest path. Neighbours are never gathered: each step is a minimum,
    added up before the shuffle, and a join whose hot keys Spark can split. Each round is
    written to the shared folder. Null nodes and loops are left out.
    """
    links = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u") != F.col("v")).distinct()
    links = materialize(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).hint("rebalance")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m")).hint("rebalance")
        small = down.join(least, "u")
        links = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        links = materialize(links.where(F.col("u") != F.col("v")).distinct(), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
