"""Profiles of Bronze that grow load by load, kept as sketches beside the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.operators.profile import ADDED, merged_profile, profile_parts
from veilwork.schemas import DOMAINS
from veilwork.sources.tables import TableStore

PROFILES = "bronze/_profiles"
PROFILES_SCHEMA = (
    "domain string, _load_id string, column_name string, "
    + ", ".join(f"`{c}` {'double' if c in ('_length', '_squares') else 'bigint'}" for c in ADDED)
    + ", _min double, _max double, _seen binary, _lengths binary"
)


def profile_loads(store: TableStore, domain: str) -> DataFrame:
    """Sketch the finished loads that have no sketches yet, and return (load_id) of these.

    Only their partitions are read. A run that fails leaves nothing behind, and the next one
    sketches its loads.
    """
    known = store.read(PROFILES, PROFILES_SCHEMA).where(F.col("domain") == domain).select(F.col("_load_id").alias("load_id"))
    open_loads = store.committed_loads(domain).join(known.distinct(), "load_id", "left_anti")
    rows = [(r["load_id"],) for r in open_loads.collect()]  # one short id per new load
    fresh = store.spark.createDataFrame(rows, "load_id string")
    if rows:
        cells = store.read_bronze(domain, fresh, with_load=True).select("_load_id", *DOMAINS[domain].source_columns)
        parts = profile_parts(cells, ["_load_id"]).withColumn("domain", F.lit(domain))
        store.append(PROFILES, parts.select(*store.read(PROFILES, PROFILES_SCHEMA).columns).coalesce(1))
    return fresh


def bronze_profile(store: TableStore, domain: str) -> DataFrame:
    """The domain's column profiles over all sketched loads; Bronze itself is not read."""
    return merged_profile(store.read(PROFILES, PROFILES_SCHEMA).where(F.col("domain") == domain))
