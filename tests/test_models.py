import math
import re
from collections import Counter

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from opsignal.config import CATEGORIES
from opsignal.operators import classify, evaluate
from opsignal.streaming import score

WORDS = {c: c.lower() for c in CATEGORIES}


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    for i in range(100):
        c = CATEGORIES[i % 5]
        rows.append((f"S{i:03d}", c, f"{WORDS[c]} seen on host{i % 7}", [float(i % 5 == k) + 0.01 * (i % 3) for k in range(5)]))
    return spark.createDataFrame(rows, "signal_id string, category string, preprocessed_text string, embedding array<float>")


@pytest.mark.parametrize("backend", ["lexical", "dense"])
def test_training_run(spark, frame, backend, tmp_path):
    model, held_out = classify.train_pipeline(frame, backend)
    assert held_out.count() == 20 and model.backend == backend
    said = classify.predict(model, held_out)
    rows = said.collect()
    assert len(rows) == 20 and set(said.columns) == {
        "signal_id", "predicted_category", "confidence", "all_probabilities", "backend_used"
    }
    for r in rows:
        assert 0 <= r["confidence"] <= 1
        assert abs(sum(r["all_probabilities"].values()) - 1) < 1e-3
    score = evaluate.evaluate_classifier(said.join(held_out.select("signal_id", "category"), "signal_id")).first()
    assert score["accuracy"] == 1.0
    path = str(tmp_path / backend)
    classify.save_classifier(model, path)
    again = classify.predict(classify.load_classifier(spark, path), held_out)
    assert sorted(map(tuple, again.drop("all_probabilities").collect())) == sorted(
        map(tuple, said.drop("all_probabilities").collect())
    )


def test_native_margins_equal_the_fitted_model(spark, frame):
    ready = frame.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))).withColumn(
        "label", classify.label_index(F.col("category")).cast("double")
    )
    fitted = classify.train_classifier(ready)
    model = classify.fit_classifier(frame, "dense")
    want = {r["signal_id"]: max(r["probability"]) for r in fitted.transform(ready).collect()}
    got = {r["signal_id"]: r["confidence"] for r in classify.predict(model, frame).collect()}
    assert all(abs(got[k] - want[k]) < 2e-4 for k in want)


def test_lexical_margins_equal_plain_sums(spark, frame):
    model, held_out = classify.train_pipeline(frame, "lexical")
    terms = {r["term"]: r for r in model.terms.collect()}
    texts = dict(held_out.select("signal_id", "preprocessed_text").collect())
    texts |= {"again": "host1 host1 seen host1 seen on", "none": "zzz", "empty": "", "null": None}
    rows = spark.createDataFrame(list(texts.items()), "signal_id string, preprocessed_text string")
    said = {r["signal_id"]: r["all_probabilities"] for r in classify.predict(model, rows).collect()}
    for key, text in texts.items():
        words = re.findall(r"\w{2,}", (text or "").lower())
        tf = Counter(t for t in words + [f"{a} {b}" for a, b in zip(words, words[1:])] if t in terms)
        raw = {t: (1 + math.log(n)) * terms[t]["idf"] for t, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        margins = [b + sum(v / norm * terms[t]["coef"][i] for t, v in raw.items()) for i, b in enumerate(model.intercepts)]
        total = sum(math.exp(m) for m in margins)
        for label, m in zip(model.labels, margins):
            assert abs(said[key][label] - math.exp(m) / total) < 1e-4


def test_prediction_is_a_projection_in_batch_and_stream(spark, frame, tmp_path):
    model, held_out = classify.train_pipeline(frame, "lexical")
    said = classify.predict(model, held_out)
    plan = said._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Aggregate [", "Join", "Generate", "from_json", "JsonToStructs"))
    folder = str(tmp_path / "arriving")
    held_out.select("signal_id", "preprocessed_text").write.parquet(folder)
    arriving = spark.readStream.schema("signal_id string, preprocessed_text string").parquet(folder)
    streamed = score.classify_stream(arriving, model, str(tmp_path / "kept"))
    want = said.select("signal_id", "predicted_category", "confidence")
    assert sorted(streamed.collect()) == sorted(want.collect())
    held_out.limit(3).select("signal_id", "preprocessed_text").coalesce(1).write.mode("append").parquet(folder)
    assert score.classify_stream(arriving, model, str(tmp_path / "kept")).count() == held_out.count() + 3


def test_unknown_text_still_gets_a_prediction(spark, frame):
    model, _ = classify.train_pipeline(frame, "lexical")
    other = spark.createDataFrame([("X", "zzz qqq"), ("Y", "")], "signal_id string, preprocessed_text string")
    assert {r["signal_id"] for r in classify.predict(model, other).collect()} == {"X", "Y"}


def test_missing_artefact(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="train_pipeline"):
        classify.load_classifier(spark, str(tmp_path / "none"))


def test_class_metrics_with_an_absent_class(spark):
    df = spark.createDataFrame([("Network Outage", "Network Outage"), ("Security Breach", "Network Outage")], "category string, predicted_category string")
    report = {r["category"]: r for r in evaluate.class_report(df).collect()}
    assert report["Network Outage"]["precision"] == 0.5 and report["Deployment Failure"]["support"] == 0
    assert evaluate.evaluate_classifier(df).first()["accuracy"] == 0.5
    assert evaluate.confusion_counts(df).count() == 25
