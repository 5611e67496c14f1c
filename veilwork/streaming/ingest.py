"""Continuous Bronze and Silver loading."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilwork.plans.silver import RUNS, RUNS_SCHEMA, settle_loads, silver_table, unlogged
from veilwork.schemas import DOMAINS, Domain
from veilwork.session import materialize
from veilwork.sources.csv_drop import file_columns, ingest_files
from veilwork.sources.tables import MANIFEST, MANIFEST_SCHEMA, RUN, TableStore

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_bronze(store: TableStore, folder: str, checkpoint: str) -> StreamingQuery:
    """Ingest the files of all domains as they arrive, as `ingest` does.

    The stream finds new files; each micro-batch hands their names to the batch code, which
    reads headers, routes to domains, reads quoted line breaks and leaves out what the
    manifest has. So a repeated micro-batch, a new checkpoint or files that a batch run has
    loaded add nothing twice, and any number of folders and checkpoints can feed one store.
    """
    files = (
        store.spark.readStream.schema(BINARY_FILE)
        .format("binaryFile")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .load(folder)
    )

    def load(batch: DataFrame, epoch: int) -> None:
        ingest_files(store, batch)

    return (
        file_columns(files).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settle_epoch(store: TableStore, domain: Domain, as_of: dt.date, batch: DataFrame, run_id: str) -> int:
    """Settle the loads of one micro-batch as the run of that name; returns the rows added.

    The first row of a key wins across all epochs: the keys taken so far are Silver's own, which
    is stored by key and read in place. What is written has the epoch's name, so an epoch that is
    repeated replaces what its first attempt left, or does nothing where that reached the log.
    """
    logged = store.read(RUNS, RUNS_SCHEMA).where(F.col("domain") == domain.name)
    if not logged.where(F.col("run_id") == run_id).isEmpty():
        return 0
    loads = batch.where(F.col("domain") == domain.name).select("load_id").distinct()
    # A batch run may have settled some of them.
    pending = materialize(loads.join(logged.select("load_id"), "load_id", "left_anti"), "pending")
    if pending.isEmpty():
        return 0
    own = F.col(RUN) == run_id
    silver = store.keyed(silver_table(domain)).where(~own)
    done = unlogged(store, domain, logged).where(~own)
    return settle_loads(store, domain, as_of, pending, run_id, silver, done, repeat=True)["inserted"]


def stream_silver(store: TableStore, domain: str | None, as_of: dt.date, checkpoint: str) -> StreamingQuery:
    """Settle Bronze loads of one domain, or of all, as the manifest grows.

    Each micro-batch reads the loads that its manifest entries name and no others. Epochs are
    named by the stream's own id, which a new checkpoint changes.
    """
    domains = [DOMAINS[domain]] if domain else list(DOMAINS.values())
    entries = store.spark.readStream.schema(MANIFEST_SCHEMA).parquet(store.path(MANIFEST))

    def load(batch: DataFrame, epoch: int) -> None:
        entered = materialize(batch.select("domain", "load_id").distinct(), "entered")
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        for one in domains:
            settle_epoch(store, one, as_of, entered, f"{stream}-{epoch}")

    return (
        entries.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
