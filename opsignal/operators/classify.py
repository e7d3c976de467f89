"""Label index, training and prediction.

Training is Spark ML's multinomial logistic regression. Prediction is one expression over
a row, in batch and stream alike: the capped vocabulary is a literal that finds a term by its
hash, its coefficients are literal arrays, and class margins are sums over the terms of the row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from opsignal.config import Config, DEFAULT
from opsignal.functions.text import feature_terms, ngrams
from opsignal.functions.rounding import round_half_up
from opsignal.operators.ranking import stratified_split
from opsignal.operators.similarity import resolve_backend
from opsignal.operators.tfidf import TfidfModel, sublinear, tfidf_fit
from opsignal.session import materialise, new_path

#: Terms or dimensions of a model up to which its numbers stand in the expression.
MODEL_ROWS = 100_000


def label_index(col: Column, cfg: Config = DEFAULT) -> Column:
    """Position in the alphabetical category list, stable if a category is absent."""
    pairs = [F.lit(x) for i, c in enumerate(sorted(cfg.categories)) for x in (c, i)]
    return F.try_element_at(F.create_map(*pairs), col)


@dataclass(frozen=True)
class Classifier:
    """``terms``: ``(term, idx, idf, coef array)``, for dense input ``(idx, coef array)``."""

    backend: str
    labels: list[str]
    intercepts: list[float]
    terms: DataFrame
    max_ngram: int = 2


@dataclass(frozen=True)
class Vocabulary:
    """Terms as a literal, found by their hash, with their idf by number."""

    maps: Column
    parts: int
    idf: Column
    size: int
    max_ngram: int

    def weighted(self, df: DataFrame, text_column: str) -> DataFrame:
        """``df`` with ``_raw``: ``(idx, raw)`` of the known terms of each row, by number, without a shuffle.

        Numbers are sorted, so that the occurrences of a term are one run; a run's length is the
        distance of its end from the end before.
        """

        def number(term: Column) -> Column:
            part = F.element_at(self.maps, (F.pmod(F.xxhash64(term), F.lit(self.parts)) + 1).cast("int"))
            return F.try_element_at(part, term)

        def ended(p: Column, i: Column) -> Column:
            return F.struct(p["before"].alias("idx"), i.alias("at"), (p["idx"].isNull() | (p["idx"] != p["before"])).alias("end"))

        def raw(run: Column, before: Column) -> Column:
            weight = sublinear(run["at"] - before) * F.element_at(self.idf, run["idx"] + 1)
            return F.struct(run["idx"].alias("idx"), weight.alias("raw"))

        terms = F.coalesce(ngrams(feature_terms(F.col(text_column)), self.max_ngram), F.array().cast("array<string>"))
        found = df.withColumn("_ids", F.sort_array(F.filter(F.transform(terms, number), lambda x: x.isNotNull())))
        beside = F.zip_with(
            "_ids", F.concat(F.array(F.lit(-1)), "_ids"), lambda x, b: F.struct(x.alias("idx"), b.alias("before"))
        )
        ends = F.filter(F.transform(beside, ended), lambda r: r["end"] & (r["idx"] >= 0))
        found = found.withColumn("_ends", ends).drop("_ids")
        each = F.zip_with("_ends", F.concat(F.array(F.lit(0)), F.col("_ends")["at"]), raw)
        return found.withColumn("_raw", F.filter(each, lambda r: r["idx"].isNotNull())).drop("_ends")


def vocabulary_lookup(vocab: DataFrame, max_ngram: int) -> tuple[Vocabulary, list]:
    """``vocab(term, idx, idf, ...)`` as a literal, and its rows in the order of ``idx``."""
    rows = _model_rows(vocab.withColumn("_h", F.xxhash64("term")))
    parts = max(1, len(rows) // 4)
    maps: list[dict] = [{} for _ in range(parts)]
    for r in rows:
        maps[r["_h"] % parts][r["term"]] = r["idx"]
    lookup = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
    return Vocabulary(lookup, parts, F.lit(np.array([r["idf"] for r in rows], float)), len(rows), max_ngram), rows


def _model_rows(table: DataFrame) -> list:
    """Rows of a model in the order of ``idx``, which counts from 0; ``MODEL_ROWS`` at most."""
    rows = table.orderBy("idx").limit(MODEL_ROWS + 1).collect()
    if len(rows) > MODEL_ROWS:
        raise ValueError(f"a model of more than {MODEL_ROWS} terms or dimensions")
    return rows


def _norm(raw: Column) -> Column:
    return F.sqrt(F.aggregate(raw, F.lit(0.0), lambda a, r: a + r["raw"] * r["raw"]))


def _sparse_features(df: DataFrame, model: TfidfModel, text_column: str) -> DataFrame:
    """``features, label`` per row, written; a row without known terms gets the zero vector.

    The columns are written as the four fields of a sparse vector and read back as vectors.
    """
    lookup, _ = vocabulary_lookup(model.vocab, model.max_ngram)
    norm = df.select("label", text_column).transform(lookup.weighted, text_column).withColumn("_norm", _norm(F.col("_raw")))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(lookup.size).alias("size"),
        F.col("_raw")["idx"].alias("indices"),
        F.transform(F.arrays_zip("_raw", F.array_repeat("_norm", F.size("_raw"))), lambda x: x["_raw"]["raw"] / x["1"]).alias("values"),
    )
    path = new_path(df.sparkSession, "features")
    norm.select(vector.alias("features"), F.col("label").cast("double").alias("label")).write.parquet(path)
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def train_classifier(df: DataFrame, cfg: Config = DEFAULT, strength: float = 1.0):
    """Fit on ``features`` and ``label``; the objective has an unpenalised intercept."""
    rows = df.count()
    return LogisticRegression(
        family="multinomial",
        regParam=1.0 / (strength * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
    ).fit(df.select("features", "label"))


def _coefficients(spark: SparkSession, fitted, classes: int) -> DataFrame:
    matrix = fitted.coefficientMatrix.toArray()
    rows = [(i, [float(matrix[c][i]) for c in range(matrix.shape[0])]) for i in range(matrix.shape[1])]
    return spark.createDataFrame(rows, "idx int, coef array<double>")


def fit_classifier(
    train: DataFrame,
    backend: str = "auto",
    text_column: str = "preprocessed_text",
    vector: str = "embedding",
    key: str = "signal_id",
    cfg: Config = DEFAULT,
) -> Classifier:
    """Features of the training rows only, then the regression."""
    used = resolve_backend(train, backend, vector)
    labels = sorted(cfg.categories)
    train = train.withColumn("label", label_index(F.col("category"), cfg).cast("double"))
    spark = train.sparkSession
    if used == "dense":
        ready = train.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
        fitted = train_classifier(materialise(ready.select("features", "label"), "features"), cfg)
        terms = _coefficients(spark, fitted, len(labels))
        return Classifier(used, labels[: fitted.numClasses], list(map(float, fitted.interceptVector)), terms)
    model = tfidf_fit(train, text_column, key, cfg)
    model = TfidfModel(materialise(model.vocab, "vocabulary"), model.max_ngram)
    fitted = train_classifier(_sparse_features(train, model, text_column), cfg)
    terms = materialise(
        model.vocab.join(F.broadcast(_coefficients(spark, fitted, len(labels))), "idx"), "coefficients"
    )
    return Classifier(
        used, labels[: fitted.numClasses], list(map(float, fitted.interceptVector)), terms, model.max_ngram
    )


def _lexical_margins(model: Classifier, df: DataFrame, text_column: str, key: str) -> DataFrame:
    """``(key, m0, m1, ...)`` of every row: sums over its known terms."""
    lookup, rows = vocabulary_lookup(model.terms, model.max_ngram)
    known = lookup.weighted(df.select(key, text_column), text_column)

    def margin(i: int, b: float) -> Column:
        coef = F.lit(np.array([r["coef"][i] for r in rows], float))
        total = F.aggregate("_raw", F.lit(0.0), lambda a, r: a + r["raw"] * F.element_at(coef, r["idx"] + 1))
        return F.lit(b) + F.when(F.size("_raw") > 0, total / F.col("_norm")).otherwise(F.lit(0.0))

    known = known.withColumn("_norm", _norm(F.col("_raw")))
    return known.select(key, *(margin(i, b).alias(f"m{i}") for i, b in enumerate(model.intercepts)))


def _dense_margins(model: Classifier, df: DataFrame, vector: str, key: str) -> DataFrame:
    rows = _model_rows(model.terms)

    def margin(i: int, b: float) -> Column:
        weights = F.lit(np.array([r["coef"][i] for r in rows], float))
        products = F.zip_with(F.col(vector), weights, lambda x, w: x * w)
        return (F.lit(b) + F.aggregate(products, F.lit(0.0), lambda a, x: a + x)).alias(f"m{i}")

    return df.select(key, *(margin(i, b) for i, b in enumerate(model.intercepts)))


def predict(
    model: Classifier,
    df: DataFrame,
    text_column: str = "preprocessed_text",
    vector: str = "embedding",
    key: str = "signal_id",
) -> DataFrame:
    """``(key, predicted_category, confidence, all_probabilities, backend_used)`` per row.

    A projection: ``df`` may be a stream. A null or unknown text gets the class of the largest intercept.
    """
    if model.backend == "dense":
        margins = _dense_margins(model, df, vector, key)
    else:
        margins = _lexical_margins(model, df, text_column, key)
    names = [f"m{i}" for i in range(len(model.labels))]
    top = F.greatest(*names)
    shifted = margins.select(key, *(F.exp(F.col(m) - top).alias(m) for m in names))
    total = reduce(lambda a, b: a + b, (F.col(m) for m in names))
    probs = shifted.select(key, F.array(*(F.col(m) / total for m in names)).alias("p"))
    labels = F.array(*map(F.lit, model.labels))
    best = F.array_max("p")
    return probs.select(
        key,
        # The first of equal probabilities wins.
        F.element_at(labels, F.array_position("p", best).cast("int")).alias("predicted_category"),
        round_half_up(best).alias("confidence"),
        F.map_from_arrays(labels, F.transform("p", lambda x: round_half_up(x))).alias("all_probabilities"),
        F.lit(model.backend).alias("backend_used"),
    )


def train_pipeline(
    df: DataFrame, backend: str = "auto", cfg: Config = DEFAULT, key: str = "signal_id"
) -> tuple[Classifier, DataFrame]:
    """Split, fit on the training part, and return the model with the held-out rows."""
    parts = materialise(stratified_split(df, "category", cfg.test_fraction, key), "split")
    model = fit_classifier(parts.filter(~F.col("is_test")).drop("is_test"), backend, key=key, cfg=cfg)
    return model, parts.filter("is_test").drop("is_test")


def save_classifier(model: Classifier, path: str) -> None:
    """Model tables under ``path``: coefficients and one row of settings."""
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    settings = [(model.backend, model.labels, model.intercepts, model.max_ngram)]
    schema = "backend string, labels array<string>, intercepts array<double>, max_ngram int"
    model.terms.sparkSession.createDataFrame(settings, schema).write.mode("overwrite").parquet(f"{path}/settings")


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    try:
        settings = spark.read.parquet(f"{path}/settings").first()
        terms = spark.read.parquet(f"{path}/terms")
    except AnalysisException as err:
        raise FileNotFoundError(f"no classifier at {path}: run train_pipeline and save_classifier first") from err
    return Classifier(
        settings["backend"], list(settings["labels"]), list(settings["intercepts"]), terms, settings["max_ngram"]
    )
