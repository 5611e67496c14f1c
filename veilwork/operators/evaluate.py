"""Quality of a classification, from (label, predicted) counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.functions.patterns import ratio


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * n)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_classes"))
    # One total row; attached through a constant key rather than a cross join.
    keyed = sizes.withColumn("_k", F.lit(1)).join(totals.withColumn("_k", F.lit(1)), "_k")
    return keyed.select(label, "n", (F.col("_rows") / (F.col("_classes") * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    return df.join(class_weights(df, label).select(label, "weight"), label)


def _pairs(df: DataFrame, label: str, predicted: str, confidence: str | None = None) -> DataFrame:
    extra = [F.sum(confidence).alias("_conf")] if confidence else []
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), *extra
    )


def class_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """(label, precision, recall, f1, support) for every class seen in either column."""
    pairs = _pairs(df, label, predicted)
    right = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    actual = pairs.groupBy("label").agg(F.sum("n").alias("support"), right.alias("hits"))
    guessed = pairs.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("guesses"))
    both = actual.join(guessed, "label", "full").na.fill(0, ["support", "hits", "guesses"])
    precision = ratio(F.col("hits"), F.col("guesses"))
    recall = ratio(F.col("hits"), F.col("support"))
    return both.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"),
        F.col("support"),
    )


def overall_metrics(
    df: DataFrame, label: str = "label", predicted: str = "predicted", confidence: str = "confidence"
) -> DataFrame:
    """One row: accuracy, support-weighted precision, recall and F1, mean confidence, rows."""
    report = class_report(df, label, predicted)
    share = F.col("support")
    weighted = report.agg(
        F.sum("support").alias("rows"),
        (F.sum(F.col("precision") * share) / F.sum(share)).alias("precision"),
        (F.sum(F.col("recall") * share) / F.sum(share)).alias("recall"),
        (F.sum(F.col("f1") * share) / F.sum(share)).alias("f1"),
    )
    totals = df.agg(
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"),
        F.avg(confidence).alias("avg_confidence"),
    )
    joined = weighted.withColumn("_k", F.lit(1)).join(totals.withColumn("_k", F.lit(1)), "_k")
    return joined.select("accuracy", "precision", "recall", "f1", "avg_confidence", "rows")


def confusion_matrix(
    df: DataFrame, classes: list[str], label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """One row per class and one column per predicted class, in the given order, zeros kept."""
    spark = df.sparkSession
    wide = (
        _pairs(df, label, predicted)
        .groupBy("label")
        .pivot("predicted", classes)
        .agg(F.sum("n"))
    )
    order = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], "position int, label string")
    return (
        order.join(wide, "label", "left").na.fill(0).orderBy("position").select("label", *classes)
    )


def compare_models(results: dict[str, DataFrame]) -> DataFrame:
    """Union of the overall metrics of several approaches."""
    frames = [overall_metrics(df).select(F.lit(name).alias("approach"), "*") for name, df in results.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def mistakes_first(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Wrong predictions before right ones, each by rising confidence."""
    return df.withColumn("correct", F.col(label) == F.col(predicted)).orderBy("correct", "confidence")
