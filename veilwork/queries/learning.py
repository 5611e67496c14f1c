"""Classifier evaluation and training."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veilwork.functions.patterns import PROFILE_FEATURES
from veilwork.operators import evaluate as E
from veilwork.operators.keys import stable_hash
from veilwork.operators.ranks import stratified_split
from veilwork.plans import gold, train
from veilwork.plans.rules import classify_by_rules, combine
from veilwork.queries import query
from veilwork.queries.governance import BANKING_TYPES, features_of, warehouse
from veilwork.queries.views import table
from veilwork.schemas import star_constraints
from veilwork.session import materialize, scratch_path
from veilwork.sources import labelled

CLASSES = ["bad", "good", "toxic"]


def judged(spark, folder):
    """Documents with a class from `labels` and a class guessed from source and length."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    rows = docs.join(table(spark, folder, "labels"), "doc_id")
    label = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("bad")
    guess = F.when(F.col("n_chars") > 900, "good").when(F.col("lang") == "en", "toxic").otherwise("bad")
    return rows.select(
        "doc_id", label.alias("label"), guess.alias("predicted"), ((F.col("n_chars") % 100) / 100).alias("confidence")
    )


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("class_distribution")
def _(spark, folder):
    return E.class_distribution(judged(spark, folder))


@query("class_weights")
def _(spark, folder):
    return _rounded(E.class_weights(judged(spark, folder)))


@query("overall_metrics")
def _(spark, folder):
    return _rounded(E.overall_metrics(judged(spark, folder)))


@query("class_report")
def _(spark, folder):
    return _rounded(E.class_report(judged(spark, folder)))


@query("confusion_matrix")
def _(spark, folder):
    return E.confusion_matrix(judged(spark, folder), CLASSES)


@query("compare_models")
def _(spark, folder):
    rows = judged(spark, folder)
    always_good = rows.withColumn("predicted", F.lit("good"))
    return _rounded(E.compare_models({"by length": rows, "always good": always_good}))


@query("mistakes_first")
def _(spark, folder):
    return E.mistakes_first(judged(spark, folder))


@query("stratified_split")
def _(spark, folder):
    rows = judged(spark, folder).select("doc_id", "label")
    return stratified_split(rows, "label", stable_hash(F.lit("42"), F.col("doc_id")), "doc_id")


@query("stratified_split_lineitem")
def _(spark, folder):
    """A table whose classes each hold about a third of all rows, and which has duplicate keys."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    marked = stratified_split(rows, "l_returnflag", stable_hash(F.col("l_orderkey")), "l_linenumber", 0.15)
    return marked.groupBy("l_returnflag", "is_test").agg(F.count(F.lit(1)).alias("n"))


# ---- training -------------------------------------------------------------------------

MEDICAL_TYPES = {
    "patient_id": "DIRECT_IDENTIFIER", "blood_group": "HEALTH_INFORMATION", "diagnosis": "HEALTH_INFORMATION",
    "medical_record_number": "MEDICAL_RECORD_NUMBER", "doctor_name": "PERSON_NAME", "day_name": "NON_PII",
    "month_name": "NON_PII", "full_date": "NON_PII", "year": "NON_PII", "admission_count": "NON_PII",
}
OTHER_TYPES = {
    "student_id": "DIRECT_IDENTIFIER", "course": "NON_PII", "department": "NON_PII", "percentage": "NON_PII",
    "age": "DEMOGRAPHIC_INFORMATION", "gender": "DEMOGRAPHIC_INFORMATION", "campaign_name": "NON_PII", "channel": "NON_PII",
}
KEY_TYPES = {
    k: "NON_PII"
    for k in (
        "customer_key", "account_key", "location_key", "patient_key", "doctor_key", "diagnosis_key",
        "admission_date_key", "date_key", "student_key", "course_key", "department_key", "enrollment_date_key",
        "campaign_key", "channel_key", "campaign_date_key",
    )
}


def training_rows(spark, folder, groups=12):
    """Labelled columns sampled from the star tables; the labels are set by hand, per column."""
    tables = warehouse(spark, folder)
    types = BANKING_TYPES | MEDICAL_TYPES | OTHER_TYPES | KEY_TYPES
    labels = {(t, c): types[c] for (_, t), df in tables.items() for c in df.columns if c in types}
    inventory = gold.column_inventory(
        gold.catalog_columns(spark, tables), gold.constraint_rows(spark, star_constraints())
    )
    rows = labelled.prepare(labelled.from_tables(tables, labels, inventory, groups))
    return tables, materialize(rows, "labelled")


@query("training_rows")
def _(spark, folder):
    return training_rows(spark, folder)[1]


@query("pattern_inspection")
def _(spark, folder):
    """Label and format shares of every training row."""
    rows = train.with_features(training_rows(spark, folder)[1])
    names = [*PROFILE_FEATURES[:3], *PROFILE_FEATURES[4:7]]
    return rows.select("domain", "table_name", "column_name", "sample_group", "label", *names)


@query("feature_vectors")
def _(spark, folder):
    """Fused feature vectors and the encoded label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer

    rows = train.with_features(training_rows(spark, folder)[1])
    index = StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc")
    model = Pipeline(stages=[index, *train.feature_stages("hybrid")]).fit(rows)
    vector = vector_to_array("features")
    return model.transform(rows).select(
        "table_name", "column_name", "sample_group", "label", "label_index",
        F.size(vector).alias("dimensions"), F.slice(vector, train.EMBEDDING_SIZE + 1, 3).alias("first_extras"),
    )


@query("model_comparison")
def _(spark, folder):
    """Text only, with patterns, and the full feature set, on one split."""
    rows = train.with_features(training_rows(spark, folder)[1])
    return train.compare(rows).metrics


@query("model_invariants")
def _(spark, folder):
    """What holds for any fitted classifier: chances add up to 1, the highest one is predicted, and
    the compared accuracy is the share of held-out rows whose prediction is right."""
    rows = train.with_features(training_rows(spark, folder)[1])
    result = train.compare(rows)
    model, found = result.models["hybrid"], materialize(result.predictions["hybrid"], "predictions")
    chances = vector_to_array("probability")
    scored = model.transform(rows).select(
        F.abs(F.aggregate(chances, F.lit(0.0), lambda a, x: a + x) - 1).alias("off"),
        (F.element_at(chances, F.col("prediction").cast("int") + 1) == F.array_max(chances)).alias("highest"),
    )
    one = F.lit(1).alias("one")
    whole = scored.agg((F.max("off") < 1e-9).alias("sums_to_one"), F.bool_and("highest").alias("predicts_highest"))
    share = found.agg(F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("share"))
    told = result.metrics.where("approach = 'hybrid'").select("accuracy", one)
    converged = model.stages[-1].summary.totalIterations < 3000
    return whole.select("*", one).join(share.select("*", one), "one").join(told, "one").select(
        "sums_to_one", "predicts_highest", (F.abs(F.col("share") - F.col("accuracy")) < 1e-6).alias("accuracy_recomputed"),
        (F.col("accuracy") > 0.8).alias("better_than_most"), F.lit(converged).alias("converged"),
    )


@query("bundle_round_trip")
def _(spark, folder):
    """A model written with its description and read back: the same predictions for every row."""
    rows = materialize(train.with_features(training_rows(spark, folder)[1]), "rows")
    model, path = train.fit(rows, "text"), scratch_path(spark, "bundle")
    train.save_bundle(model, path, "1.0.0", rows.count(), "text")
    loaded, about = train.load_bundle(spark, path)
    key = ["table_name", "column_name", "sample_group"]
    first, second = (train.predict(m, rows).select(*key, "predicted", "confidence") for m in (model, loaded))
    return first.exceptAll(second).agg(
        (F.count(F.lit(1)) == 0).alias("same_predictions"),
        F.lit(about["total_feature_dimension"]).cast("bigint").alias("dimensions"),
        F.lit(about["classes"] == sorted(about["classes"]) and len(about["classes"]) > 10).alias("classes_sorted"),
        F.lit(about["training_rows"] == rows.count()).alias("rows_told"),
    )


@query("labelled_round_trip")
def _(spark, folder):
    """Training rows written as CSV and read back as labelled data: nothing is lost or changed."""
    rows = training_rows(spark, folder)[1].select(*labelled.COLUMNS)
    path = scratch_path(spark, "labelled")
    blank = rows.limit(5).withColumn("label", F.lit(None).cast("string"))
    padded = rows.withColumn("label", F.concat(F.lit(" "), "label", F.lit(" ")))
    padded.unionByName(blank).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in labelled.COLUMNS])
    again = labelled.load(spark, path).select(*labelled.COLUMNS)
    lost, new = text.exceptAll(again), again.exceptAll(text)
    return lost.unionByName(new).agg(F.count(F.lit(1)).alias("different_rows"))


@query("embedding_comparison")
def _(spark, folder):
    """Hashed and learned text vectors, on one split and in every approach."""
    rows = train.with_features(training_rows(spark, folder)[1])
    return train.compare(rows, embeddings=(train.HASHED, train.LEARNED)).metrics


@query("neural_comparison")
def _(spark, folder):
    """The neural network on the full feature set."""
    rows = train.with_features(training_rows(spark, folder)[1])
    return train.compare(rows, (train.NEURAL,)).metrics


@query("model_scan")
def _(spark, folder):
    """Every warehouse column classified by a model fitted on all training rows, with rules."""
    tables, rows = training_rows(spark, folder)
    model = train.fit(train.with_features(rows))
    features = materialize(features_of(spark, tables), "features")
    by_model = train.as_scan(model)(features)
    combined = gold.scan_outcome(combine(classify_by_rules(features), by_model))
    return combined.select(
        "schema_name", "table_name", "column_name", "pii_type", "ml_probability", "final_confidence",
        "detection_method", "pii_detected", "pii_records_detected",
    )
