"""What a task holds and how often texts are read, in the shared steps of many queries."""

import math

from pyspark.sql import functions as F

from opsignal.config import Config
from opsignal.functions import text as T
from opsignal.operators import classify, preprocess, reports, tfidf
from opsignal.sources import views


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sets_are_compared_by_value(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    right = spark.createDataFrame([("b",), ("b",), ("c",)], "x string")
    assert {r[0] for r in reports.only_left(left, right, "x").collect()} == {None, "a"}
    assert [r[0] for r in reports.in_both(left, right, "x").collect()] == ["b"]
    for found in (reports.only_left(left, right, "x"), reports.in_both(left, right, "x")):
        after = plan(found).split("Join", 1)[1]
        assert after.count("Aggregate [") == 2


def test_rows_are_dealt_into_parts_without_a_sort(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "ROWS_PER_TASK", 10)
    path = str(tmp_path / "rows")
    spark.range(200).withColumn("t", F.lit("x")).coalesce(1).write.parquet(path)
    dealt = views.spread_rows(spark.read.parquet(path))
    assert dealt.rdd.getNumPartitions() == 20 and "RoundRobin" not in dealt._jdf.queryExecution().toString()
    assert sorted(r["id"] for r in dealt.collect()) == list(range(200))
    assert max(map(len, dealt.rdd.glom().collect())) < 40
    assert "RoundRobin" not in views.spread(spark.read.parquet(path))._jdf.queryExecution().toString()


def test_idf_counts_signals_without_moving_texts(spark):
    rows = [("S1", "aa bb aa"), ("S2", "aa bb aa"), ("S3", "bb cc"), ("S4", None), ("S5", "")]
    df = spark.createDataFrame(rows, "signal_id string, preprocessed_text string")
    found = tfidf.corpus_idf(df)
    got = {r["term"]: (r["df"], r["idf"]) for r in found.collect()}
    assert {t: n for t, (n, _) in got.items()} == {"aa": 2, "bb": 3, "cc": 1}
    assert all(abs(idf - (math.log(6 / (1 + n)) + 1)) < 1e-12 for n, idf in got.values())
    assert "MapInArrow" not in plan(found)


def test_fitting_deals_occurrences_into_bounded_parts(spark, monkeypatch):
    rows = [(f"S{i % 50}", f"aa bb{i % 7} aa") for i in range(100)]
    df = spark.createDataFrame(rows, "signal_id string, preprocessed_text string")
    want = sorted(tfidf.tfidf_fit(df, cfg=Config(max_features=5)).vocab.collect())
    monkeypatch.setattr(tfidf, "MET_PER_TASK", 20)
    model = tfidf.tfidf_fit(df, cfg=Config(max_features=5))
    assert sorted(model.vocab.collect()) == want
    met = sum(x for x, in df.select(F.explode(T.ngrams(T.feature_terms(F.col("preprocessed_text")), 2)).alias("t")).groupBy("t").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "t").limit(5).select("n").collect())
    assert "RepartitionByExpression [signal_id" in plan(model.vocab) and f", {-(-met // 20)}" in plan(model.vocab)


def test_known_terms_are_sorted_without_a_comparison_function(spark):
    vocab = spark.createDataFrame([("aa", 0, 1.0), ("bb", 1, 2.0)], "term string, idx int, idf double")
    lookup, _ = classify.vocabulary_lookup(vocab, 1)
    found = lookup.weighted(spark.createDataFrame([("bb aa bb",)], "t string"), "t")
    assert [(r["idx"], round(r["raw"], 6)) for r in found.first()["_raw"]] == [(0, 1.0), (1, round(2 * (1 + math.log(2)), 6))]
    assert "array_sort" not in found._jdf.queryExecution().analyzed().toString().lower().replace("sort_array", "")


def test_a_lemma_table_reads_its_texts_once(spark):
    texts = spark.createDataFrame([("S1", "hosts host boxes box"), ("S2", "cases case classes")], "signal_id string, normalised_text string")
    table = preprocess.lemma_table(preprocess.vocabulary(preprocess.with_tokens(texts)))
    assert dict(table.collect()) == {"hosts": "host", "boxes": "box", "cases": "case"}
    assert "split(" not in plan(table)
