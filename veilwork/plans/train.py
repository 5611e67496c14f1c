"""Training and applying the column classifiers with pyspark.ml."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions.patterns import (
    KEYWORDS,
    PROFILE_FEATURES,
    as_flag,
    keyword_flags,
    sample_features,
    semantic_text,
    split_samples,
)
from veilwork.operators.evaluate import compare_models, with_class_weights
from veilwork.operators.ranks import stratified_split
from veilwork.operators.keys import stable_hash
from veilwork.session import materialize
from veilwork.schemas import PII_TYPES

EMBEDDING_SIZE = 384
EXTRA_SIZE = len(PROFILE_FEATURES) + len(KEYWORDS) + 2
FEATURE_SIZE = EMBEDDING_SIZE + EXTRA_SIZE
SEED = 42
WORD_VECTOR_PASSES = 10
TRAINING_ROWS_A_TASK = 20_000
SIDE_BY_SIDE = 4  # models fitted at the same time

LOGISTIC = "logistic"
NEURAL = "neural"
HIDDEN_LAYERS = (512, 256, 128)


def with_features(rows: DataFrame) -> DataFrame:
    """Add the sentence, the 18 sample features, the keyword vector and the key flags.

    Takes labelled rows, whose samples are '|'-joined, and scanned columns, whose samples
    are arrays.
    """
    if "samples" not in rows.columns:
        rows = rows.withColumn("samples", split_samples(F.col("sample_values")))
    rows = rows.withColumn("samples", F.slice("samples", 1, 5))
    if "semantic_text" not in rows.columns:
        parts = ("domain", "table_name", "table_type", "column_name", "data_type", "samples")
        rows = rows.withColumn("semantic_text", semantic_text(*[F.col(c) for c in parts]))
    if PROFILE_FEATURES[0] not in rows.columns:
        rows = rows.select("*", *sample_features(F.col("samples")))
    return rows.withColumns(
        {
            "keyword_vector": array_to_vector(keyword_flags(F.col("column_name"))),
            "pk_flag": as_flag(F.col("is_primary_key")).cast("double"),
            "fk_flag": as_flag(F.col("is_foreign_key")).cast("double"),
        }
    )


HASHED, LEARNED = "hashed", "learned"


def text_stages(kind: str = HASHED) -> list:
    """A unit-length vector of the sentence, standing in for a pretrained embedding.

    Hashed: TF-IDF of its words. Learned: the mean of word vectors that are fitted on the
    sentences themselves, so that words of like company lie close.
    """
    words = RegexTokenizer(inputCol="semantic_text", outputCol="_words", pattern="[^a-z0-9@.]+")
    if kind == LEARNED:
        return [
            words,
            Word2Vec(
                inputCol="_words", outputCol="_mean", vectorSize=EMBEDDING_SIZE, minCount=1, windowSize=5,
                maxIter=WORD_VECTOR_PASSES, stepSize=0.05, seed=SEED,
            ),
            Normalizer(inputCol="_mean", outputCol="embedding"),
        ]
    return [
        words,
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=EMBEDDING_SIZE),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="embedding"),
    ]


def _scaled(inputs: list[str], raw: str, out: str) -> list:
    return [
        VectorAssembler(inputCols=inputs, outputCol=raw),
        StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True),
    ]


KEY_FLAGS = ["pk_flag", "fk_flag"]


def with_encoded_text(rows: DataFrame, encode: Callable[[list[str]], np.ndarray], column: str = "encoded") -> DataFrame:
    """Add the vectors that a user's own model gives the sentences, for `fit(embedding=column)`.

    `encode` takes a list of sentences and returns one row of EMBEDDING_SIZE numbers for each. It
    is called with whole Arrow batches on the executors, so a model loads once per worker if it
    is cached in the function's module.
    """

    @F.pandas_udf("array<double>")
    def vectors(sentences: pd.Series) -> pd.Series:
        out = np.asarray(encode(sentences.fillna("").tolist()), dtype=float)
        if out.shape != (len(sentences), EMBEDDING_SIZE):
            raise ValueError(f"{out.shape} numbers for {len(sentences)} sentences of {EMBEDDING_SIZE}")
        return pd.Series(list(out))

    return rows.withColumn(column, array_to_vector(vectors("semantic_text")))


def feature_stages(approach: str, embedding: str | None = None) -> list:
    """Stages up to `features` for one of the three compared approaches.

    `embedding` is HASHED, LEARNED, or names an existing vector column.
    """
    built_in = embedding in (None, HASHED, LEARNED)
    text = text_stages(embedding or HASHED) if built_in else []
    column = "embedding" if built_in else embedding
    if approach == "text":
        return text + _scaled([column, *KEY_FLAGS], "_raw", "features")
    if approach == "text+patterns":
        return text + _scaled([column, *PROFILE_FEATURES, *KEY_FLAGS], "_raw", "features")
    if approach == "hybrid":
        # Only the engineered features are scaled; the text vector already has length 1.
        extra = _scaled([*PROFILE_FEATURES, "keyword_vector", *KEY_FLAGS], "_extra", "_extra_scaled")
        return [*text, *extra, VectorAssembler(inputCols=[column, "_extra_scaled"], outputCol="features")]
    raise ValueError(f"unknown approach {approach!r}")


APPROACHES = ("text", "text+patterns", "hybrid")


def classifier(kind: str, rows: int, inputs: int, classes: int, max_iter: int | None = None):
    if kind == LOGISTIC:
        # L2 with C = 1: the penalty weighs 1/n against the mean loss, as balanced weights sum to n.
        return LogisticRegression(
            labelCol="label_index", weightCol="weight", family="multinomial", standardization=False,
            regParam=1.0 / rows, elasticNetParam=0.0, maxIter=max_iter or 3000,
        )
    if kind == NEURAL:
        return MultilayerPerceptronClassifier(
            labelCol="label_index", layers=[inputs, *HIDDEN_LAYERS, classes], seed=SEED, maxIter=max_iter or 100
        )
    raise ValueError(f"unknown classifier {kind!r}")


def fit(
    rows: DataFrame, approach: str = "hybrid", kind: str = LOGISTIC,
    max_iter: int | None = None, embedding: str | None = None,
) -> PipelineModel:
    """Train on labelled rows that have their features."""
    n, classes = rows.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    # Each iteration is a job over these rows: few rows in many tasks cost more than they gain. They
    # are dealt out, not coalesced: one task would hold the memory of all tasks before it.
    dealt = with_class_weights(rows).repartition(max(1, -(-n // TRAINING_ROWS_A_TASK)))
    weighted = dealt.sortWithinPartitions("semantic_text", "label").cache()
    try:
        size = EMBEDDING_SIZE + {"text": 2, "text+patterns": 20, "hybrid": EXTRA_SIZE}[approach]
        index = StringIndexer(
            inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="error"
        )
        stages = [index, *feature_stages(approach, embedding), classifier(kind, n, size, classes, max_iter)]
        return Pipeline(stages=stages).fit(weighted)
    finally:
        weighted.unpersist()


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add `predicted`, `probability_of_label` and `confidence` (the highest probability)."""
    names = F.array(*[F.lit(x) for x in labels_of(model)])
    # The label index is for fitting only; rows to predict may have no label, or a new one.
    scored = PipelineModel(stages=model.stages[1:]).transform(rows)
    chances = vector_to_array("probability")
    position = F.col("prediction").cast("int") + 1
    return scored.select(
        *rows.columns,
        F.element_at(names, position).alias("predicted"),
        F.element_at(chances, position).alias("probability_of_label"),
        F.array_max(chances).alias("confidence"),
    )


def as_scan(model: PipelineModel):
    """A `classify` function for the Gold scan."""

    def classify(features: DataFrame) -> DataFrame:
        scored = predict(model, with_features(features))
        return scored.select(
            *features.columns,
            F.col("predicted").alias("pii_type"),
            F.col("probability_of_label").alias("ml_probability"),
            F.col("confidence").alias("final_confidence"),
            F.lit("ML").alias("detection_method"),
        )

    return classify


def split(rows: DataFrame, fraction: float = 0.2) -> DataFrame:
    """Add `is_test`, the same for every approach and every run."""
    identity = [F.lit(str(SEED)), *[F.col(c) for c in ("table_name", "column_name", "sample_values", "label")]]
    hashed = stable_hash(*identity)
    return stratified_split(rows, "label", hashed, "sample_values", fraction)


@dataclass
class Comparison:
    models: dict[str, PipelineModel]
    predictions: dict[str, DataFrame]
    metrics: DataFrame


def compare(
    rows: DataFrame,
    kinds: tuple[str, ...] = (LOGISTIC,),
    max_iter: int | None = None,
    embeddings: tuple[str, ...] = (HASHED,),
) -> Comparison:
    """Train each approach on the same split and score it on the held-out rows.

    The neural network is compared on the full feature vector only. With several embeddings,
    an approach is named `approach/embedding`.
    """
    marked = materialize(split(rows), "split")
    train, test = marked.where("NOT is_test"), marked.where("is_test")
    jobs = []
    for embedding in embeddings:
        more = f"/{embedding}" if len(embeddings) > 1 else ""
        if LOGISTIC in kinds:
            jobs += [(approach + more, approach, LOGISTIC, embedding) for approach in APPROACHES]
        if NEURAL in kinds:
            jobs.append(("neural" + more, "hybrid", NEURAL, embedding))
    # The models are independent of one another, and an iteration of one keeps few cores busy.
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        fitted = pool.map(lambda job: fit(train, job[1], job[2], max_iter, job[3]), jobs)
        models = dict(zip([name for name, *_ in jobs], fitted, strict=True))
    predictions = {name: predict(model, test) for name, model in models.items()}
    return Comparison(models, predictions, compare_models(predictions))


PREDICTION_COLUMNS = (
    "domain", "table_name", "table_type", "column_name", "data_type", "label", "predicted", "confidence",
)


def export_predictions(predictions: DataFrame, path: str) -> None:
    out = predictions.select(*PREDICTION_COLUMNS).withColumn("correct", F.col("label") == F.col("predicted"))
    out.write.mode("overwrite").option("header", True).csv(path)


def export_comparison(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(path)


# ---- bundle ---------------------------------------------------------------------------

METADATA_KEYS = (
    "model_name", "version", "kind", "approach", "classes", "column_name_keywords",
    "pattern_feature_names", "embedding_dimension", "extra_feature_dimension",
    "total_feature_dimension", "training_rows", "random_state",
)


def save_bundle(
    model: PipelineModel, path: str, version: str, training_rows: int,
    approach: str = "hybrid", kind: str = LOGISTIC,
) -> None:
    """Write the fitted stages and a JSON description next to each other."""
    spark = SparkSession.getActiveSession()
    values = (
        "pii-classifier", version, kind, approach, labels_of(model), list(KEYWORDS),
        list(PROFILE_FEATURES), EMBEDDING_SIZE, EXTRA_SIZE, FEATURE_SIZE, training_rows, SEED,
    )
    model.write().overwrite().save(f"{path}/model")
    text = json.dumps(dict(zip(METADATA_KEYS, values)))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """The model and its description, after checking both for completeness and known classes."""
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    missing = [k for k in METADATA_KEYS if k not in metadata]
    if missing:
        raise ValueError(f"model bundle lacks {missing}")
    model = PipelineModel.load(f"{path}/model")
    classes = labels_of(model)
    if classes != metadata["classes"]:
        raise ValueError("model and metadata disagree on the classes")
    unknown = sorted(set(classes) - set(PII_TYPES))
    if unknown:
        raise ValueError(f"classes outside the taxonomy: {unknown}")
    return model, metadata
