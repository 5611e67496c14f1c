"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can change in a running session.
TUNING = {
    # HotSpot never compiles methods beyond 8000 bytes, and a wide row of cleaners becomes
    # one; above the limit Spark splits the work into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Skew handling and partition sizing are left to AQE; these only make it explicit.
DEFAULTS = TUNING | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> None:
    """Apply TUNING to a session made elsewhere."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)


def get_session(app: str = "veilwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every executor can reach.

    Where it is unset, a local master gets a temporary folder; a cluster has to
    name one, since its executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="veilwork-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back, so it is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
