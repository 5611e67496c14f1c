import threading

import pytest
from pyspark.sql import functions as F

from veilwork.plans import train
from veilwork.sources import labelled

KINDS = {
    "email": ("EMAIL", lambda i: f"user{i}@x.org|z{i}@y.com"),
    "phone": ("PHONE", lambda i: f"98765432{i:02d}|97765432{i:02d}"),
    "first_name": ("PERSON_NAME", lambda i: "Ann|Bob|Cyd"[: 3 + 4 * (i % 3)]),
    "balance": ("FINANCIAL_INFORMATION", lambda i: f"{i}.5|{i * 7}.25"),
}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    data = [
        ("Banking", "dim_x", "DIMENSION", name, "string", "false", "false", make(i), f" {label} ")
        for name, (label, make) in KINDS.items()
        for i in range(12)
    ]
    data.append(("Banking", "dim_x", "DIMENSION", "lost", "string", "no", "no", "x", None))
    path = str(tmp_path_factory.mktemp("labelled") / "csv")
    spark.createDataFrame(data, ", ".join(f"{c} string" for c in labelled.COLUMNS)).write.option("header", True).csv(path)
    loaded = labelled.load(spark, path)
    assert loaded.count() == 48 and {r[0] for r in loaded.select("label").distinct().collect()} == {k[0] for k in KINDS.values()}
    return train.with_features(loaded).cache()


def test_compare_and_bundle(spark, rows, tmp_path):
    result = train.compare(rows, (train.LOGISTIC,), max_iter=25)
    metrics = {r["approach"]: r for r in result.metrics.collect()}
    assert set(metrics) == set(train.APPROACHES) and metrics["hybrid"]["accuracy"] == 1.0
    assert metrics["hybrid"]["rows"] == 12  # ceil(0.2 * 12) of each class
    scored = result.predictions["hybrid"].collect()
    assert all(r["probability_of_label"] == r["confidence"] for r in scored)
    model = train.fit(rows, max_iter=25)
    train.save_bundle(model, str(tmp_path / "bundle"), "1.0.0", rows.count())
    loaded, about = train.load_bundle(spark, str(tmp_path / "bundle"))
    assert about["total_feature_dimension"] == 438 and about["classes"] == sorted(k[0] for k in KINDS.values())
    same = train.predict(loaded, rows).where(F.col("predicted") == F.col("label")).count()
    assert same == rows.count()
    train.export_predictions(result.predictions["hybrid"], str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 12


def test_training_rows_are_dealt_out_and_in_order(spark, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(train.Pipeline, "fit", lambda self, weighted: seen.append(weighted))
    train.fit(rows.repartition(40), "text")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString() + seen[0]._jdf.queryExecution().analyzed().toString()
    assert "Repartition 1, true" in plan and "Repartition 1, false" not in plan  # false is a coalesce
    sentences = [r["semantic_text"] for r in seen[0].collect()]
    assert len(sentences) == 48 and sentences == sorted(sentences)


def test_models_are_fitted_side_by_side(rows, monkeypatch):
    met, fit = threading.Barrier(3, timeout=120), train.fit

    def wait_and_fit(*args):
        met.wait()  # broken unless the three approaches are under way at once
        return fit(*args)

    monkeypatch.setattr(train, "fit", wait_and_fit)
    result = train.compare(rows, max_iter=2)
    assert list(result.models) == list(train.APPROACHES) == list(result.predictions)


def test_unknown_classes_are_refused(spark, rows, tmp_path):
    model = train.fit(rows.withColumn("label", F.concat("label", F.lit("?"))), max_iter=2)
    train.save_bundle(model, str(tmp_path / "bundle"), "1.0.0", 1)
    with pytest.raises(ValueError, match="taxonomy"):
        train.load_bundle(spark, str(tmp_path / "bundle"))


def test_neural_network(spark, rows):
    model = train.fit(rows, kind=train.NEURAL, max_iter=6)
    assert train.predict(model, rows).count() == rows.count()


def test_learned_and_own_text_vectors(spark, rows):
    result = train.compare(rows, max_iter=15, embeddings=(train.HASHED, train.LEARNED))
    metrics = {r["approach"]: r["accuracy"] for r in result.metrics.collect()}
    assert set(metrics) == {f"{a}/{e}" for a in train.APPROACHES for e in (train.HASHED, train.LEARNED)}
    assert metrics["text/learned"] >= 0.7  # four classes
    vectors = result.models["text/learned"].transform(rows).select("embedding").limit(5).collect()
    assert all(v[0].size == train.EMBEDDING_SIZE and abs(v[0].norm(2) - 1) < 1e-9 for v in vectors)

    def encode(sentences):
        import numpy as np

        out = np.zeros((len(sentences), 384))
        for i, s in enumerate(sentences):
            out[i, sum(map(ord, s.split("Column: ")[1].split(".")[0])) % 384] = 1
        return out

    own = train.with_encoded_text(rows, encode)
    model = train.fit(own, "text", max_iter=15, embedding="encoded")
    assert train.predict(model, own).where("predicted = label").count() == rows.count()
    with pytest.raises(Exception, match="numbers for"):
        train.with_encoded_text(rows, lambda s: [[0.0]] * len(s)).select("encoded").collect()
