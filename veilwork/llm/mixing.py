"""Mix sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_TOKENS = 16
SHARD_TOKENS = 1 << 20


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Add weight and target to (source, source_size): one row per source.

    Sources in code point order, null last, take the weights in turn. They share the whole
    size by weight; a target stops at `most` times its source's size and what it leaves goes
    to the others by weight. Sorted by size per weight, the sources that stop come first, so
    running sums give the level without iterating. One row per source meets in one task.
    """
    order = W.Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    place = (F.row_number().over(order) - 1) % len(weights)
    rows = sources.withColumn("weight", F.get(cycle, place)).withColumn("cap", most * F.col("source_size"))
    tight = W.Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tight.rowsBetween(W.Window.unboundedPreceding, -1)
    everything = W.Window.partitionBy()
    spent = F.coalesce(F.sum("cap").over(before), F.lit(0))
    passed = F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn(
        "level", (F.sum("source_size").over(everything) - spent) / (F.sum("weight").over(everything) - passed)
    ).withColumn("stops", F.col("cap") < F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], key: Column, share: Column, seats: Column) -> DataFrame:
    """Add `quota`: `seats` seats of each group by highest quotients share / (2 i + 1).

    Every party surely has the seats up to `low`, and none beyond `high`: the divisor lies
    within seats +- half the number of parties. Only the quotients between are ranked, about
    four per party. Ties go to the smaller key.
    """
    whole = W.Window.partitionBy(*group)
    rows = parties.withColumns({"_key": key, "_share": share.cast("double"), "_seats": seats})
    rows = rows.withColumn("_sum", F.sum("_share").over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
    even = F.when(F.col("_sum") > 0, F.col("_share") * F.col("_seats") / F.col("_sum")).otherwise(0.0)
    slack = F.when(F.col("_seats") > 0, F.col("_n") / (2 * F.col("_seats"))).otherwise(0.0)
    low = F.greatest(F.lit(0), F.floor(even * (1 - slack) - 0.5)).cast("long")
    high = F.when(even > 0, F.ceil(even * (1 + slack) + 0.5)).otherwise(0).cast("long")
    rows = rows.withColumn("_low", low).withColumn("_high", F.greatest(F.col("_low"), high))
    rows = rows.withColumn("_left", F.col("_seats") - F.sum("_low").over(whole))
    names = parties.columns
    bids = rows.withColumn(
        "_i", F.explode(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, "_high")).otherwise(F.array(F.lit(None).cast("long"))))
    )
    best = whole.orderBy(F.col("_quotient").desc_nulls_last(), F.col("_key").asc_nulls_last(), "_i")
    bids = bids.withColumn("_quotient", F.col("_share") / (2 * F.col("_i") - 1))
    bids = bids.withColumn("_won", (F.row_number().over(best) <= F.col("_left")) & F.col("_i").isNotNull())
    return bids.groupBy(*names).agg((F.max("_low") + F.count_if("_won")).alias("quota"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """How many words of every row the mix takes.

    Returns doc_id, the columns named in `keep`, source, size, source_size, target, taken;
    one row per input row, repeated rows included.

    All words make ceil(words / block_tokens) blocks, given to the sources by Sainte-Lague,
    and each source's blocks to its shards likewise. A shard is a hash range of about
    `shard_tokens` words, so a source with most of the rows is many tasks. In a shard the
    rows lie in an order drawn from `seed`, as one stream of words; its quota of blocks is
    taken from the start of the stream, again from the start when it is used up, `most`
    times at most.

    A null or empty text has size 0 and nothing taken. A null source is a source of its own,
    after the others; a null doc_id is drawn like any other. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        *[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)],
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
    ).withColumn("_draw", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    all_blocks = F.ceil(F.sum("source_size").over(W.Window.partitionBy()) / block_tokens).cast("long")
    quotas = apportion(targets.withColumn("_blocks", all_blocks), [], F.col("source"), F.col("target"), F.col("_blocks"))
    quotas = quotas.select("source", "source_size", "target", F.col("quota").alias("source_quota"))
    quotas = quotas.withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens)).cast("long"))

    part = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long")
    placed = rows.join(quotas.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.drop("_source").withColumn("_shard", F.floor(part * F.col("_shards") / (1 << 32)).cast("long"))
    shards = placed.groupBy("source", "_shard").agg(
        F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota")
    )
    shards = apportion(shards, ["source"], F.col("_shard"), F.col("shard_size"), F.col("source_quota"))
    shards = shards.select(
        F.col("source").alias("_source"),
        F.col("_shard").alias("_in_shard"),
        "shard_size",
        F.least(F.col("quota") * block_tokens, most * F.col("shard_size")).alias("shard_taken"),
    )
    placed = placed.join(
        shards, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_in_shard"))
    )
    kept = [f"_keep_{i}" for i in range(len(keep))]
    stream = W.Window.partitionBy("source", "_shard").orderBy("_draw", "doc_id", "size", *kept)
    start = F.sum("size").over(stream.rowsBetween(W.Window.unboundedPreceding, 0)) - F.col("size")
    turns = F.when(F.col("shard_size") > 0, F.floor(F.col("shard_taken") / F.col("shard_size"))).otherwise(0)
    rest = F.col("shard_taken") - turns * F.col("shard_size")
    taken = turns * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return placed.select(
        "doc_id",
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        "source",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
    )
