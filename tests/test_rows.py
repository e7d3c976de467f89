import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opsignal.functions import clock, scoring
from opsignal.operators import anomaly, classify, ranking, validate
from opsignal.sources import signals as store

DAY = dt.datetime(2024, 1, 1)


def frame(spark, hours):
    rows = [(f"S{i:03d}", DAY + dt.timedelta(hours=h)) for i, h in enumerate(hours)]
    return clock.with_time_features(spark.createDataFrame(rows, "signal_id string, timestamp timestamp"))


def test_equal_hours_give_zero(spark):
    scored = anomaly.score_anomalies(frame(spark, range(24))).collect()
    assert {r["z_score"] for r in scored} == {0.0} and not any(r["is_anomalous"] for r in scored)


def test_one_busy_hour(spark):
    df = frame(spark, [13] * 10 + [20])
    base = anomaly.hourly_baseline(df).collect()
    assert len(base) == 24 and sum(r["count"] for r in base) == 11
    by_hour = {r["hour"]: r for r in anomaly.score_anomalies(df).collect()}
    assert by_hour[13]["z_score"] == 3.0 and by_hour[13]["is_anomalous"]
    assert by_hour[13]["time_context"] == "business_hours" and by_hour[20]["time_context"] == "off_hours"


def test_confidence_formula(spark):
    df = spark.createDataFrame([(1.0, 0.8, 0.5), (None, None, None), (1.0, 1.0, 9.0)], "w double, c double, a double")
    got = [r[0] for r in df.select(scoring.confidence(F.col("w"), F.col("c"), F.col("a"))).collect()]
    assert got == [0.845, 0.15, 1.0]


SIGNAL = ("S1", "alert", "Network Outage", "text", DAY, "I1")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), store.SCHEMA)


def test_gate_passes_and_stops(spark):
    assert validate.require_valid(raw(spark, SIGNAL)).count() == 1
    bad = validate.require_valid(raw(spark, SIGNAL, ("S2", "pager", *SIGNAL[2:])))
    with pytest.raises(PySparkException):
        bad.collect()
    for later in (bad.select("text"), bad.groupBy("category").count()):
        with pytest.raises(PySparkException):
            later.collect()
    with pytest.raises(ValueError):
        validate.require_valid(raw(spark, SIGNAL).drop("text"))


def test_report_on_missing_column_and_null(spark):
    report = dict(validate.validation_report(raw(spark, SIGNAL).drop("category")).collect())
    assert report == {
        "Required columns present": False, "source_type values valid": True,
        "category values valid": False, "No nulls in required columns": False,
    }
    report = dict(validate.validation_report(raw(spark, (*SIGNAL[:3], None, *SIGNAL[4:]))).collect())
    assert report["No nulls in required columns"] is False and report["category values valid"] is True


def test_unknown_source_weighs_nothing(spark):
    df = spark.createDataFrame([("alert",), ("pager",), (None,)], "source_type string")
    assert [r["source_weight"] for r in clock.with_source_weight(df).collect()] == [1.0, 0.0, 0.0]


def test_global_rank_with_ties(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id").repartition(8)
    got = ranking.global_rank(df, [F.desc("k"), F.asc("id")]).collect()
    want = sorted(((r["k"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))
    assert {(r["k"], r["id"]): r["rank"] for r in got} == {x: i + 1 for i, x in enumerate(want)}


def test_split_is_exact_per_label(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("S"), "id").alias("signal_id"), F.when(F.col("id") % 10 < 7, "x").otherwise("y").alias("category")
    )
    parts = ranking.stratified_split(df)
    n = {(r["category"], r["is_test"]): r["count"] for r in parts.groupBy("category", "is_test").count().collect()}
    assert n == {("x", True): 140, ("x", False): 560, ("y", True): 60, ("y", False): 240}


def test_label_index_is_stable(spark):
    df = spark.createDataFrame([("Security Breach",), ("Authentication Failure",), ("other",)], "c string")
    assert [r[0] for r in df.select(classify.label_index(F.col("c"))).collect()] == [4, 0, None]


def test_sources(spark, tmp_path):
    df = raw(spark, SIGNAL, ("S2", "log", "Security Breach", 'a "quoted", line\nbreak', DAY, "I2"))
    for fmt in ("csv", "json", "parquet"):
        path = store.write_signals(df, str(tmp_path / fmt), fmt)
        assert sorted(store.read_signals(spark, path, fmt, multi_line=True).collect()) == sorted(df.collect())
    with pytest.raises(FileNotFoundError):
        store.read_signals(spark, str(tmp_path / "none"), "parquet")
    found = store.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "parquet")])
    assert found.count() == 2
    with pytest.raises(FileNotFoundError):
        store.first_existing(spark, [str(tmp_path / "none")])
