"""The operators over the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm import ann, chaining, decontam, jaccard, licenses, line_dedup, lm, minhash, mixing, tokens, toxicity, turns, url_rules

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ann_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every row whose id is divisible by 20."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, exact or with edits."""
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(toxicity.fold(F.col("doc_id"), 3) != 1)
    settings = toxicity.Settings()
    weights = toxicity.fit(docs, labels, "toxic", settings)
    return toxicity.score(docs, weights, settings, keep=["doc_id"]).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= settings.cut).cast("int").alias("predicted"),
    )


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the target mix takes of every document."""
    taken = mixing.mix_sources(table(spark, folder, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every url."""
    return url_rules.judge_urls(table(spark, folder, "pages"))


def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every text under a bigram model of the rows that are not held out."""
    return lm.score_texts(table(spark, folder, "documents"), toxicity.fold(F.col("doc_id"), 7) != 2)


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are 85 % alike."""
    return jaccard.similar_components(table(spark, folder, "documents"), words=4, percent=85)


def op8_shared_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that documents share, as rows of each of the two."""
    return chaining.both_sides(chaining.shared_passages(table(spark, folder, "documents")))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines found in ten documents or more are dropped everywhere."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    n_lines = F.size(line_dedup.lines_of(F.col("text")))
    return rows.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.size("kept_lines")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept_lines", "\n"), 256).alias("kept_sha256"),
    )


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in every text."""
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    fixed = turns.repair_conversations(table(spark, folder, "conversations"), turns.damaged)
    return fixed.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"),
    )


def op12_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are 80 % alike."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=2, percent=80)


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of a byte-level and a piece tokenizer overlap in every text."""
    rows = tokens.align_tokenizers(table(spark, folder, "documents"), digest=True)
    return rows.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {
    "op1_ann_search": op1_ann_search,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_url_rules": op5_url_rules,
    "op6_lm_score": op6_lm_score,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_shared_passages": op8_shared_passages,
    "op9_line_dedup": op9_line_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
