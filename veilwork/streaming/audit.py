"""Running access-audit roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilwork.plans.reports import AUDIT_KEYS


def audit_windows(log: DataFrame, every: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Accesses per window and audit key; rows later than `late` behind are left out."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", every), *AUDIT_KEYS)
        .agg(F.count(F.lit(1)).alias("accesses"))
        .select(F.col("window.start").alias("window_start"), *AUDIT_KEYS, "accesses")
    )


def write_audit(log: DataFrame, path: str, checkpoint: str, every: str = "1 day") -> StreamingQuery:
    """Append finished windows to parquet; a window is finished once the watermark has passed it."""
    return (
        audit_windows(log, every)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
