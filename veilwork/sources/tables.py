"""Parquet tables under one root folder."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.schemas import DOMAINS

MANIFEST = "bronze/_ingestion_manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("manifest_id", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("file_signature", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("ingestion_batch_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        # The first row id that no file up to this one uses.
        T.StructField("next_id", T.LongType()),
    ]
)


# Loads whose rows were packed into another partition; see sources/compact.py.
PACKS = "bronze/_packs"
PACKS_SCHEMA = "domain string, load_id string, pack_id string"
FROM_LOAD = "_from_load"  # in packs, the load of a row

LAYOUT = "_layout"
RUN = "_run"


@dataclass(frozen=True)
class Keyed:
    """A table that is stored by hash buckets of `by`, each sorted, with one partition per run.

    A join or anti-join on `by` reads it bucket by bucket: only the other side is shuffled, so
    what a run moves grows with its batch and not with the history.
    """

    name: str
    schema: T.StructType
    by: tuple[str, ...]


class TableStore:
    """Append-only parquet tables, addressed as 'layer/table' under `root`.

    `root` has to be a folder that all executors reach. `buckets` is the number of buckets of
    keyed tables, the same for all of them; it is settled when the store's first keyed table is
    written and read back from then on. By default it is the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._wanted_buckets = buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.schema("_ string").parquet(self.path(name))
        except AnalysisException:
            return False
        return True

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The table, or an empty frame of its schema where it does not exist yet."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path(name))
        known = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return rows.select(*known.names)

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        df.write.mode("append").partitionBy(*partition_by).parquet(self.path(name))

    # ---- keyed tables ---------------------------------------------------------------

    @cached_property
    def buckets(self) -> int:
        if not self.exists(LAYOUT):
            number = self._wanted_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.append(LAYOUT, self.spark.createDataFrame([(number,)], "buckets int").coalesce(1))
        # Two first writers at once would leave two rows; both then take the lower number.
        return self.read(LAYOUT, "buckets int").agg(F.min("buckets")).first()[0]

    def _declared(self, table: Keyed) -> str:
        """The table's name in the session's catalog, which knows its buckets and runs.

        The catalog entry only describes the files, so any session can make it again.
        """
        ident = "veilwork_" + hashlib.md5(self.path(table.name).encode()).hexdigest()
        if not self.spark.catalog.tableExists(ident):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
            by = ", ".join(f"`{c}`" for c in table.by)
            place = self.path(table.name).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {ident} ({columns}, {RUN} string) USING parquet PARTITIONED BY ({RUN}) "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
        if self.exists(table.name):  # other sessions may have added runs
            self.spark.sql(f"ALTER TABLE {ident} RECOVER PARTITIONS")
        return ident

    def keyed(self, table: Keyed) -> DataFrame:
        """Its rows with `_run`, known to be bucketed."""
        if not self.exists(table.name):
            return self.spark.createDataFrame([], T.StructType([*table.schema, T.StructField(RUN, T.StringType())]))
        return self.spark.table(self._declared(table))

    def runs(self, table: Keyed) -> set[str]:
        """The runs that have written rows, finished or not; one short string each."""
        if not self.exists(table.name):
            return set()
        rows = self.spark.sql(f"SHOW PARTITIONS {self._declared(table)}").collect()
        return {r["partition"].removeprefix(f"{RUN}=") for r in rows}

    def append_keyed(self, table: Keyed, rows: DataFrame, run: str, replace: bool = False) -> None:
        """Add the rows of one run, each bucket as one sorted file; `replace` drops the run's earlier ones."""
        ident = self._declared(table)
        placed = rows.select(*table.schema.names).repartition(self.buckets, *table.by).sortWithinPartitions(*table.by)
        into = "OVERWRITE" if replace else "INTO"
        rows.sparkSession.sql(f"INSERT {into} TABLE {ident} PARTITION ({RUN} = '{run}') SELECT * FROM {{rows}}", rows=placed)

    # ---- Bronze ---------------------------------------------------------------------

    def manifest(self) -> DataFrame:
        return self.read(MANIFEST, MANIFEST_SCHEMA)

    def committed_loads(self, domain: str) -> DataFrame:
        """(load_id) of the finished loads: those with a manifest entry."""
        return self.manifest().where(F.col("domain") == domain).select("load_id").distinct()

    def read_bronze(self, domain: str, loads: DataFrame | None = None, with_load: bool = False) -> DataFrame:
        """Rows of finished loads only, or of those in `loads` (load_id); `with_load` keeps `_load_id`.

        The join prunes the scan to the partitions of these loads at run time. Files that a
        failed load left behind have no manifest entry and stay invisible. The loads, one short
        row each, are broadcast: shuffled, all rows of a load would meet in one task.
        """
        names = DOMAINS[domain].bronze_schema.names
        extra = [T.StructField(FROM_LOAD, T.StringType()), T.StructField("_load_id", T.StringType())]
        loads = self.committed_loads(domain) if loads is None else loads
        rows = self.read(f"bronze/{domain}", T.StructType([*DOMAINS[domain].bronze_schema, *extra]))
        packs = self.read(PACKS, PACKS_SCHEMA).where(F.col("domain") == domain).select(F.col("load_id").alias("_load"), "pack_id")
        wanted = loads.select("load_id").distinct().join(packs, F.col("load_id") == F.col("_load"), "left")
        wanted = wanted.select(F.coalesce("pack_id", "load_id").alias("_part"), F.col("load_id").alias("_of"))
        load = F.coalesce(FROM_LOAD, "_load_id")
        here = (F.col("_load_id") == F.col("_part")) & (load == F.col("_of"))
        found = rows.join(F.broadcast(wanted), here, "left_semi")
        return found.select(*names, *([load.alias("_load_id")] if with_load else []))
