"""Packing many small Bronze loads into few files, without changing what readers see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilwork.sources.tables import FROM_LOAD, PACKS, PACKS_SCHEMA, TableStore

TARGET_BYTES = 128 << 20


def load_sizes(store: TableStore, domain: str) -> DataFrame:
    """(load_id, bytes, files) of the partitions on disk, from a listing; contents are not read."""
    files = store.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    listed = files.load(store.path(f"bronze/{domain}")).select("path", "length")
    load = F.url_decode(F.regexp_extract("path", "/_load_id=([^/]*)/", 1))
    return listed.groupBy(load.alias("load_id")).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")
    )


def pack_loads(store: TableStore, domain: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack small finished loads into files of about `target_bytes`; returns how many were packed.

    Loads below half the target that are in no pack yet are taken in order and cut into bins by
    their running size. Each bin becomes one file of rows sorted by id, in a partition of its
    own; rows keep their ids and load ids. The entry in PACKS, written last and at once, is what
    makes readers go to the new partition. Old partitions stay, so a reader that was planned
    before still finds its files; `replaced_loads` lists what can be removed later.
    """
    if not store.exists(f"bronze/{domain}"):
        return 0
    packed = store.read(PACKS, PACKS_SCHEMA).where(F.col("domain") == domain)
    small = (
        store.committed_loads(domain)
        .join(load_sizes(store, domain).where(F.col("bytes") * 2 < target_bytes), "load_id")
        .join(packed.select("load_id"), "load_id", "left_anti")
    )
    # One short row per load.
    before = F.sum("bytes").over(Window.orderBy("load_id")) - F.col("bytes")
    bins = small.withColumn("bin", F.floor(before / target_bytes))
    bins = bins.withColumn("mates", F.count(F.lit(1)).over(Window.partitionBy("bin"))).where("mates > 1")
    run = uuid.uuid4().hex
    chosen = [(domain, r["load_id"], f"pack-{run}-{r['bin']}") for r in bins.select("load_id", "bin").collect()]
    if not chosen:
        return 0
    entries = store.spark.createDataFrame(chosen, PACKS_SCHEMA).coalesce(1)
    rows = store.read_bronze(domain, entries.select("load_id"), with_load=True).withColumnRenamed("_load_id", FROM_LOAD)
    place = entries.select(F.col("load_id").alias("_load"), F.col("pack_id").alias("_load_id"))
    placed = rows.join(F.broadcast(place), F.col(FROM_LOAD) == F.col("_load")).drop("_load")
    packs = len({pack for _, _, pack in chosen})
    placed.repartition(packs, "_load_id").sortWithinPartitions("_load_id", "_bronze_id").write.mode("append").partitionBy(
        "_load_id"
    ).parquet(store.path(f"bronze/{domain}"))
    store.append(PACKS, entries)
    return len(chosen)


def replaced_loads(store: TableStore, domain: str) -> DataFrame:
    """(load_id) of the partitions that only readers planned before the packing still use."""
    return store.read(PACKS, PACKS_SCHEMA).where(F.col("domain") == domain).select("load_id")


def files_read(store: TableStore, domain: str) -> int:
    """Files that a reader of all finished loads opens."""
    packs = store.read(PACKS, PACKS_SCHEMA).where(F.col("domain") == domain)
    places = store.committed_loads(domain).join(packs, "load_id", "left").select(F.coalesce("pack_id", "load_id").alias("load_id"))
    return load_sizes(store, domain).join(places, "load_id", "left_semi").agg(F.sum("files")).first()[0] or 0
