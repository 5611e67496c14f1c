"""From raw documents to a training mix: five stages over the documents of a folder.

Each stage takes (spark, docs, folder) and returns the rows it keeps, with the columns of
documents; the last one adds how much of each document the mix takes. A stage reads what the
one before it has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm import decontam, jaccard, line_dedup, mixing, toxicity
from veilwork.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more go; it learns from all labels."""
    settings = toxicity.Settings()
    weights = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", settings)
    score = "toxicity"
    while score in docs.columns:
        score += "_"
    return toxicity.score(docs, weights, settings, column=score).where(F.col(score) < settings.cut).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a line found in ten documents or more, only the first occurrence stays.

    Documents stay, if need be with an empty text; a null text stays null. n_chars follows
    the text.
    """
    rows = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, keep_first=True))
    text = F.when(F.col("text").isNotNull(), F.array_join("kept_lines", "\n"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns if c != "kept_lines"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by 0.8 similarity of five-word shingles."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, exact or with edits, go."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words of, with their size and the words taken."""
    added = {"doc_id", "source", "size", "source_size", "target", "taken"}  # these replace columns of the name
    mix = mixing.mix_sources(docs, keep=[c for c in docs.columns if c not in added])
    return mix.where(F.col("taken") > 0)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


# The classifier's scores are no SQL; tests/llm holds each stage against a plain version.
ORACLE_SQL = None
