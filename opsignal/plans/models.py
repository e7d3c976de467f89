"""Queries on features, classifiers, stored artefacts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsignal.functions import text as T
from opsignal.functions.rounding import round_half_up
from opsignal.operators import classify, correlate, evaluate, preprocess, ranking, reports, similarity, tfidf
from opsignal.operators.pairstats import compare_backends, focus_pairs
from opsignal.plans import checksql as C
from opsignal.plans.corpus import CORPUS, CORRELATED, VECTORS, correlated, counted_pairs, named_text_pairs, prepared, stage
from opsignal.plans.correlation import PAIRS, narrow_counts
from opsignal.plans.registry import query
from opsignal.plans.texts import PRE_EVENTS, TOK_EVENTS
from opsignal.session import materialise, new_path
from opsignal.sources import signals as store, views

EVENT = C.with_(C.EVENT)
SIGNAL_COLUMNS = "signal_id, source_type, category, text, timestamp, incident_group"


def events(spark, sf):
    return views.signals(spark, sf, "event_signals")


# --- sources and sinks -----------------------------------------------------------


@query("q_s1_csv_source", EVENT + f"SELECT {SIGNAL_COLUMNS} FROM event_signals")
def s1(spark, sf):
    path = store.write_signals(events(spark, sf), new_path(spark, "csv"), "csv")
    return store.read_signals(spark, path, "csv")


@query("q_s1_csv_long_text", C.with_(C.DOC) + f"SELECT {SIGNAL_COLUMNS} FROM doc_signals")
def s1_docs(spark, sf):
    path = store.write_signals(views.signals(spark, sf, "doc_signals"), new_path(spark, "csv"), "csv")
    return store.read_signals(spark, path, "csv", multi_line=True)


@query("q_s2_json_source", C.with_(C.DOC) + f"SELECT {SIGNAL_COLUMNS} FROM doc_signals")
def s2(spark, sf):
    path = store.write_signals(views.signals(spark, sf, "doc_signals"), new_path(spark, "json"), "json")
    return store.read_signals(spark, path, "json")


@query("q_s3_parquet_source", C.with_(C.DOC) + f"SELECT {SIGNAL_COLUMNS} FROM doc_signals")
def s3(spark, sf):
    path = store.write_signals(views.signals(spark, sf, "doc_signals"), new_path(spark, "parquet"))
    return store.read_signals(spark, path, "parquet")


@query(
    "q_s4_write_prepared",
    C.with_(*CORPUS) + "SELECT signal_id, preprocessed_text, anomaly_score FROM corpus",
)
def s4(spark, sf):
    path = store.write_signals(prepared(spark, sf), new_path(spark, "processed"))
    return spark.read.parquet(path).select("signal_id", "preprocessed_text", "anomaly_score")


@query("q_s5_first_existing", EVENT + "SELECT signal_id, category FROM event_signals")
def s5(spark, sf):
    there = store.write_signals(events(spark, sf), new_path(spark, "processed"))
    return store.first_existing(spark, [new_path(spark, "scored"), there]).select("signal_id", "category")


@query(
    "q_s6_pairs_json",
    C.with_(*CORPUS, *VECTORS, PAIRS)
    + "SELECT signal_a, signal_b, units / 10000::DOUBLE AS similarity, n_pairs, true AS above_threshold FROM pairs",
)
def s6(spark, sf):
    found = narrow_counts(named_text_pairs(spark, sf), "n_pairs")
    return store.read_pairs(spark, store.write_json(found, new_path(spark, "pairs"), "gzip"))


@query(
    "q_s7_correlation_json",
    C.recursive(*CORRELATED)
    + """SELECT r.group_id, r.confidence_score, g.signal_id, g.timestamp FROM grouped g JOIN ranked r USING (root)""",
)
def s7(spark, sf):
    found = correlated(spark, sf)
    groups, members = correlate.group_rows(found.groups), found.members()
    path = new_path(spark, "correlation")
    store.write_correlation(groups, members, path)
    groups, members = store.read_correlation(spark, path, groups.schema, members.schema)
    return members.join(groups.select("group_id", "confidence_score"), "group_id").select(
        "group_id", "confidence_score", "signal_id", "timestamp"
    )


@query("q_s8_evaluation_json")
def s8(spark, sf):
    df = prepared(spark, sf)
    document = store.evaluation_document(
        {
            "classifier": evaluate.evaluate_classifier(df),
            "similarity": evaluate.evaluate_counted_pairs(counted_pairs(spark, sf), df),
            "correlation": evaluate.evaluate_groups(correlated(spark, sf).members(), df),
        }
    )
    path = store.write_json(document, new_path(spark, "evaluation"))
    return spark.read.schema(document.schema).json(path).select(F.to_json(F.struct("*")).alias("document"))


# --- features --------------------------------------------------------------------


def split(spark, sf):
    return stage(
        spark, sf, "split",
        lambda: materialise(ranking.stratified_split(prepared(spark, sf), "category", 0.2), "split"),
    )


def train(spark, sf):
    return split(spark, sf).filter("NOT is_test")


def test(spark, sf):
    return split(spark, sf).filter("is_test")


def fitted(spark, sf):
    def build():
        model = tfidf.tfidf_fit(train(spark, sf))
        return tfidf.TfidfModel(materialise(model.vocab, "vocabulary"), model.max_ngram)

    return stage(spark, sf, "vocabulary", build)


_GRAMS = f"""grams AS MATERIALIZED (SELECT signal_id, is_test, unnest(list_concat(tk, list_transform(range(1, greatest(len(tk), 1)),
 lambda i: concat(tk[i], ' ', tk[i + 1])))) AS term FROM (SELECT signal_id, {C.feature_terms('preprocessed_text')} AS tk,
 row_number() OVER (PARTITION BY category ORDER BY md5(signal_id), signal_id) <=
 CAST(round(CAST(0.2 AS DECIMAL(9,6)) * count(*) OVER (PARTITION BY category), 0) AS BIGINT) AS is_test FROM corpus))"""
FEATURES = (
    *CORPUS,
    _GRAMS,
    "tf AS MATERIALIZED (SELECT signal_id, is_test, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3)",
    """train_n AS (SELECT count(*) AS n FROM (SELECT row_number() OVER (PARTITION BY category ORDER BY md5(signal_id),
  signal_id) > CAST(round(CAST(0.2 AS DECIMAL(9,6)) * count(*) OVER (PARTITION BY category), 0) AS BIGINT) AS t
 FROM corpus) WHERE t)""",
    """fit AS MATERIALIZED (SELECT term, df, total, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM
 (SELECT term, count(*) AS df, sum(tf) AS total FROM tf WHERE NOT is_test GROUP BY 1 ORDER BY total DESC, term LIMIT 3000),
 train_n)""",
    """tw AS (SELECT signal_id, is_test, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY signal_id)) AS w FROM
 (SELECT signal_id, is_test, t.term, (1.0 + ln(tf)) * idf AS raw FROM tf t JOIN fit f ON t.term = f.term))""",
)
ON_FEATURES = C.with_(*FEATURES)


@query(
    "q_f1_term_counts",
    PRE_EVENTS
    + f"""SELECT signal_id, term, count(*) AS tf FROM (SELECT signal_id, unnest({C.feature_terms('preprocessed_text')}) AS term
 FROM preprocessed) GROUP BY 1, 2""",
)
def f1(spark, sf):
    df = events(spark, sf).withColumn("normalised_text", T.normalise_text(F.col("text")))
    # Written once: the lemma table and its application both read the tokens.
    df = materialise(preprocess.with_tokens(df).select("signal_id", "tokens"), "tokens", "zstd")
    lemmas = materialise(preprocess.lemma_table(preprocess.vocabulary(df)), "lemmas")
    df = preprocess.with_corpus_lemmas(df, preprocess.lemmas_in_place(lemmas))
    return tfidf.term_counts(df, "signal_id", T.feature_terms(F.array_join("tokens", " ")))


@query(
    "q_f2_smooth_idf",
    C.with_(*CORPUS, *VECTORS) + f"SELECT term, {C.rnd('idf', 6)} AS idf FROM idf",
)
def f2(spark, sf):
    return tfidf.corpus_idf(prepared(spark, sf)).select("term", round_half_up(F.col("idf"), 6).alias("idf"))


@query(
    "q_f3_vocabulary_cap",
    ON_FEATURES
    + f"SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, {C.rnd('idf', 6)} AS idf FROM fit",
)
def f3(spark, sf):
    return fitted(spark, sf).vocab.select("term", "idx", round_half_up(F.col("idf"), 6).alias("idf"))


@query(
    "q_f4_fit_transform",
    ON_FEATURES + f"SELECT signal_id, term, {C.rnd('w', 6)} AS weight FROM tw WHERE NOT is_test",
)
def f4(spark, sf):
    return tfidf.tfidf_transform(train(spark, sf), fitted(spark, sf)).withColumn(
        "weight", round_half_up(F.col("weight"), 6)
    )


@query(
    "q_f5_transform_unseen",
    ON_FEATURES + f"SELECT signal_id, term, {C.rnd('w', 6)} AS weight FROM tw WHERE is_test",
)
def f5(spark, sf):
    return tfidf.tfidf_transform(test(spark, sf), fitted(spark, sf)).withColumn(
        "weight", round_half_up(F.col("weight"), 6)
    )


@query(
    "q_f6_similarity_tfidf",
    C.with_(*CORPUS, *VECTORS) + f"SELECT key AS first_id, term, {C.rnd('w', 6)} AS weight FROM weights",
)
def f6(spark, sf):
    df = prepared(spark, sf)
    names = similarity.text_members(df).select("key", "first_id")
    return (
        tfidf.similarity_tfidf(df)
        .join(names, "key")
        .select("first_id", "term", round_half_up(F.col("weight"), 6).alias("weight"))
    )


@query("q_f7_vocabulary_size", ON_FEATURES + "SELECT count(*) AS terms FROM fit")
def f7(spark, sf):
    return fitted(spark, sf).vocab.agg(F.count("*").alias("terms"))


# --- classifiers -----------------------------------------------------------------


def described(spark, sf):
    """Event signals that have both a text and a vector."""

    def build():
        df = events(spark, sf).withColumn("normalised_text", T.normalise_text(F.col("text")))
        df = preprocess.preprocess_signals(df)
        vec = views.table(spark, sf, "embeddings").select(
            F.concat(F.lit("EVT-"), F.lpad(F.col("vec_id").cast("string"), 8, "0")).alias("signal_id"), "embedding"
        )
        return materialise(df.join(vec, "signal_id", "left"), "described")

    return stage(spark, sf, "described", build)


def texts_only(spark, sf):
    return described(spark, sf).drop("embedding")


def with_vectors(spark, sf):
    return described(spark, sf).filter("embedding IS NOT NULL")


def lexical(spark, sf):
    return stage(spark, sf, "lexical", lambda: classify.train_pipeline(texts_only(spark, sf)))


@query("q_f8_dense_features")
def f8(spark, sf):
    model, held_out = stage(
        spark, sf, "dense", lambda: classify.train_pipeline(with_vectors(spark, sf), "dense")
    )
    return classify.predict(model, held_out).drop("all_probabilities")


@query("q_m3_train_classifier")
def m3(spark, sf):
    model, _ = lexical(spark, sf)
    return model.terms.select("term", F.posexplode("coef").alias("label", "coefficient"))


@query("q_m4_predict")
def m4(spark, sf):
    model, held_out = lexical(spark, sf)
    return classify.predict(model, held_out).withColumn("all_probabilities", F.to_json("all_probabilities"))


@query("q_m5_predict_all")
def m5(spark, sf):
    model, _ = lexical(spark, sf)
    return classify.predict(model, texts_only(spark, sf)).select("signal_id", "predicted_category", "confidence")


@query("q_m7_training_run")
def m7(spark, sf):
    model, held_out = lexical(spark, sf)
    truth = held_out.select("signal_id", "category")
    return evaluate.evaluate_classifier(classify.predict(model, held_out).join(truth, "signal_id")).withColumn(
        "backend", F.lit(model.backend)
    )


@query("q_s9_save_load_classifier")
def s9(spark, sf):
    model, held_out = lexical(spark, sf)
    path = new_path(spark, "classifier")
    classify.save_classifier(model, path)
    return classify.predict(classify.load_classifier(spark, path), held_out).select(
        "signal_id", "predicted_category", "confidence"
    )


@query("q_e8_backend_comparison")
def e8(spark, sf):
    df = with_vectors(spark, sf)
    parts = []
    for backend in ("lexical", "dense"):
        model, held_out = classify.train_pipeline(df, backend)
        said = classify.predict(model, held_out).join(held_out.select("signal_id", "category"), "signal_id")
        parts.append(evaluate.tall(evaluate.evaluate_classifier(said), backend))
    return evaluate.best_per_metric(evaluate.stack(parts)).withColumnRenamed("section", "backend")


@query("q_e9_full_report")
def e9(spark, sf):
    df = prepared(spark, sf)
    found = correlated(spark, sf)
    sweep = correlate.threshold_sweep(found.links, df, (0.5, 0.35, 0.25)).select(
        F.format_string("sweep %.2f", "threshold").alias("section"),
        F.inline(
            F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("precision", "recall", "f1")))
        ),
    )
    dataset = reports.dataset_statistics(df).select(
        F.lit("dataset").alias("section"),
        F.concat_ws(" ", "metric", F.nullif("item", F.lit(""))).alias("metric"),
        F.col("value").cast("double").alias("value"),
    )
    return evaluate.stack(
        [
            dataset,
            evaluate.tall(evaluate.evaluate_classifier(df), "classifier"),
            evaluate.tall(evaluate.evaluate_counted_pairs(counted_pairs(spark, sf), df), "similarity"),
            evaluate.tall(evaluate.evaluate_groups(found.members(), df), "correlation"),
            evaluate.tall(evaluate.group_averages(found.groups), "groups"),
            sweep,
        ]
    )


_DESCRIBED = (
    *TOK_EVENTS,
    """described AS MATERIALIZED (SELECT t.*, array_to_string(tokens, ' ') AS preprocessed_text, embedding::DOUBLE[] AS v
 FROM tokenised t JOIN embeddings ON signal_id = concat('EVT-', lpad(CAST(vec_id AS STRING), 8, '0')))""",
)
_COSINE = "list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))"


def _weights_sql(source: str) -> tuple[str, ...]:
    """Term weights fitted on ``source``, one vector per signal."""
    return (
        f"""fp AS (SELECT signal_id, term, count(*) AS tf FROM (SELECT signal_id,
 unnest({C.feature_terms('preprocessed_text')}) AS term FROM {source}) GROUP BY 1, 2)""",
        f"fi AS (SELECT term, ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + count(*))) + 1.0 AS idf FROM fp GROUP BY 1)",
        """fw AS MATERIALIZED (SELECT signal_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY signal_id)) AS w
 FROM (SELECT signal_id, fp.term, tf * idf AS raw FROM fp JOIN fi ON fp.term = fi.term))""",
    )


def _with_lexical_sql(pairs: str) -> str:
    return f"""(SELECT p.*, coalesce(c, 0.0) AS c FROM {pairs} p LEFT JOIN (SELECT q.signal_a, q.signal_b, sum(x.w * y.w) AS c
 FROM {pairs} q JOIN fw x ON x.signal_id = q.signal_a JOIN fw y ON y.signal_id = q.signal_b AND y.term = x.term GROUP BY 1, 2)
 USING (signal_a, signal_b))"""


@query(
    "q_j15_compare_backends",
    C.with_(
        *_DESCRIBED,
        *_weights_sql("described"),
        f"""strata AS (SELECT *, CASE WHEN same_incident THEN 0 WHEN NOT same_category THEN 1 ELSE 2 END AS s FROM
 (SELECT a.signal_id AS signal_a, b.signal_id AS signal_b, {C.rnd(_COSINE)} AS dense_score,
 a.incident_group IS NOT DISTINCT FROM b.incident_group AS same_incident,
 a.category IS NOT DISTINCT FROM b.category AS same_category FROM described a JOIN described b ON a.signal_id < b.signal_id))""",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY dense_score DESC, signal_a, signal_b) AS r FROM strata)""",
        """shown AS MATERIALIZED (SELECT * FROM placed WHERE r <= CASE s WHEN 2 THEN 8 ELSE 4 END ORDER BY s, r LIMIT 8)""",
    )
    + f"""SELECT signal_a, signal_b, {C.rnd('c')} AS tfidf_score, dense_score, same_incident, same_category
 FROM {_with_lexical_sql('shown')}""",
)
def j15(spark, sf):
    return compare_backends(with_vectors(spark, sf), 8)


_FOCUS = ("INC-00000", "INC-00001")


def _focus_sql(source: str, prefixes: tuple[str, ...], extra: str = "") -> tuple[str, ...]:
    """Pairs of the chosen incidents: all of one incident, and the first six of different ones."""
    chosen = " OR ".join(f"starts_with(incident_group, '{p}')" for p in prefixes)
    pair = f"SELECT a.signal_id AS signal_a, b.signal_id AS signal_b{extra}"
    met = "FROM focus a JOIN focus b ON a.signal_id < b.signal_id AND a.incident_group"
    return (
        f"focus AS MATERIALIZED (SELECT * FROM {source} WHERE {chosen})",
        *_weights_sql("focus"),
        f"""chosen AS MATERIALIZED ({pair}, true AS same_incident {met} = b.incident_group
 UNION ALL SELECT * FROM ({pair}, false AS same_incident {met} <> b.incident_group ORDER BY 1, 2 LIMIT 6))""",
    )


@query(
    "q_j16_focus_comparison",
    C.with_(
        *CORPUS,
        f"focus AS (SELECT * FROM corpus WHERE {' OR '.join(f'''starts_with(incident_group, '{p}')''' for p in _FOCUS)})",
        f"""fp AS (SELECT signal_id, term, count(*) AS tf FROM (SELECT signal_id,
 unnest({C.feature_terms('preprocessed_text')}) AS term FROM focus) GROUP BY 1, 2)""",
        """fi AS (SELECT term, ln((1.0 + (SELECT count(*) FROM focus)) / (1.0 + count(*))) + 1.0 AS idf FROM fp GROUP BY 1)""",
        """fw AS (SELECT signal_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY signal_id)) AS w
 FROM (SELECT signal_id, fp.term, tf * idf AS raw FROM fp JOIN fi ON fp.term = fi.term))""",
        """fs AS (SELECT a.signal_id AS signal_a, b.signal_id AS signal_b, sum(a.w * b.w) AS c FROM fw a JOIN fw b
 ON a.term = b.term AND a.signal_id < b.signal_id GROUP BY 1, 2)""",
    )
    + f"""SELECT a.signal_id AS signal_a, b.signal_id AS signal_b, {C.rnd('coalesce(c, 0.0)', 3)} AS similarity,
 true AS same_incident FROM focus a JOIN focus b ON a.incident_group = b.incident_group AND a.signal_id < b.signal_id
 LEFT JOIN fs ON signal_a = a.signal_id AND signal_b = b.signal_id
 UNION ALL SELECT * FROM (SELECT signal_a, signal_b, {C.rnd('c', 3)} AS similarity, false AS same_incident FROM fs
 JOIN focus a ON a.signal_id = signal_a JOIN focus b ON b.signal_id = signal_b
 WHERE a.incident_group <> b.incident_group ORDER BY signal_a, signal_b LIMIT 6)""",
)
def j16(spark, sf):
    return focus_pairs(prepared(spark, sf), list(_FOCUS), sharing=True)


@query(
    "q_j16_focus_both_scores",
    C.with_(*_DESCRIBED, *_focus_sql("described", ("INC-1",), f", {C.rnd(_COSINE, 3)} AS dense_score"))
    + f"SELECT signal_a, signal_b, {C.rnd('c', 3)} AS similarity, dense_score, same_incident FROM {_with_lexical_sql('chosen')}",
)
def j16_both(spark, sf):
    return focus_pairs(with_vectors(spark, sf), ["INC-1"])
