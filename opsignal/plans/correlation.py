"""Queries on similarity, correlation and their evaluation over the document signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsignal.functions import text as T
from opsignal.functions.rounding import mean_of_units, to_units
from opsignal.operators import correlate, evaluate, preprocess, reports, similarity, timewindow
from opsignal.operators.pairstats import counted_distribution
from opsignal.plans import checksql as C
from opsignal.plans.corpus import (
    COMPONENTS,
    CORPUS,
    CORRELATED,
    DENSE,
    GROUP_COLUMNS,
    HEADERS,
    VECTORS,
    corpus_index,
    corpus_lemmas,
    counted_pairs,
    correlated,
    correlated_vectors,
    edges,
    named_text_pairs,
    prepared,
    prepared_vectors,
    PAIR_LEVELS,
)
from opsignal.plans.registry import query
from opsignal.session import materialise
from opsignal.sources import views

ON_CORPUS = C.with_(*CORPUS)
ON_TEXTS = C.with_(*CORPUS, *VECTORS)
ON_EDGES = C.with_(*CORPUS, *VECTORS, *edges())
ON_GROUPS = C.recursive(*CORRELATED)
MEMBERS = "SELECT r.group_id, g.* EXCLUDE (root) FROM grouped g JOIN ranked r USING (root)"
PAIRS = f"""pairs AS (SELECT key_a AS signal_a, key_b AS signal_b, {C.units('cosine')} AS units,
  a.copies * b.copies AS n_pairs FROM text_pairs p
  JOIN texts a ON a.key = p.key_a JOIN texts b ON b.key = p.key_b WHERE cosine >= 0.25
 UNION ALL SELECT key, key, 10000, copies * (copies - 1) // 2 FROM texts
  WHERE copies > 1 AND key IN (SELECT key FROM weights))"""


def flat(groups):
    return correlate.group_rows(groups).withColumn("source_types", F.array_join("source_types", ","))


def narrow_counts(df, *columns):
    """Wide pair counts as longs, which the test data allows."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- similarity ------------------------------------------------------------------


@query(
    "q_j5_sparse_cosine_join",
    C.with_(*CORPUS, *VECTORS, PAIRS)
    + "SELECT signal_a, signal_b, units / 10000::DOUBLE AS similarity, n_pairs, true AS above_threshold FROM pairs",
)
def j5(spark, sf):
    return narrow_counts(named_text_pairs(spark, sf), "n_pairs")


@query(
    "q_j4_oriented_pairs",
    C.with_(*CORPUS, *VECTORS, PAIRS)
    + """SELECT (SELECT CAST(sum(n_pairs) AS BIGINT) FROM pairs) AS similar_pairs,
 count(*) * (count(*) - 1) // 2 AS all_pairs FROM corpus""",
)
def j4(spark, sf):
    """Size of the upper triangle and how much of it is similar, from counts."""
    df, found = prepared(spark, sf), named_text_pairs(spark, sf)
    total = df.agg(F.count("*").alias("n")).select((F.col("n") * (F.col("n") - 1) / 2).cast("bigint").alias("all_pairs"))
    return found.agg(F.sum("n_pairs").cast("bigint").alias("similar_pairs")).join(F.broadcast(total), F.lit(True))


@query(
    "q_r6_pairs_by_score",
    C.with_(*CORPUS, *VECTORS, PAIRS)
    + """SELECT signal_a, signal_b, units / 10000::DOUBLE AS similarity FROM pairs
 ORDER BY units DESC, signal_a, signal_b""",
)
def r6(spark, sf):
    # Written, as sorting reads its rows twice.
    found = named_text_pairs(spark, sf).select("signal_a", "signal_b", "similarity")
    return similarity.ranked_pairs(materialise(found, "named_pairs", "zstd"))


VEC_PAIRS = C.with_(C.VEC) + """, vec AS MATERIALIZED (SELECT signal_id, category, incident_group,
 embedding::DOUBLE[] AS v FROM vector_signals)"""


def _dense_sql(on: str = "") -> str:
    cosine = "list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))"
    return f"""SELECT a.signal_id AS signal_a, b.signal_id AS signal_b, {C.rnd(cosine)} AS similarity,
 CAST(1 AS BIGINT) AS n_pairs, true AS above_threshold
 FROM vec a JOIN vec b ON a.signal_id < b.signal_id {on} WHERE {cosine} >= 0.25"""


@query("q_j6_dense_cosine_join", VEC_PAIRS + _dense_sql())
def j6(spark, sf):
    found = similarity.dense_similar_pairs(views.signals(spark, sf, "vector_signals"))
    return narrow_counts(found, "n_pairs")


@query("q_j6_dense_within_category", VEC_PAIRS + _dense_sql("AND a.category = b.category"))
def j6_gated(spark, sf):
    found = similarity.dense_similar_pairs(views.signals(spark, sf, "vector_signals"), keys=("category",))
    return narrow_counts(found, "n_pairs")


@query(
    "q_j14_backend_dispatch",
    VEC_PAIRS + f"SELECT signal_a, signal_b, similarity, 'dense' AS backend_used FROM ({_dense_sql()})",
)
def j14(spark, sf):
    found = similarity.similar_pairs_auto(views.signals(spark, sf, "vector_signals"))
    return found.select("signal_a", "signal_b", "similarity", "backend_used")


@query(
    "q_m6_backend_fallback",
    C.with_(*CORPUS, *VECTORS, PAIRS)
    + "SELECT 'lexical' AS backend_used, count(*) AS text_pairs FROM pairs",
)
def m6(spark, sf):
    """Dense wanted, no vector column: the lexical backend answers and says so."""
    df = prepared(spark, sf)
    used = similarity.resolve_backend(df, "dense")
    found = named_text_pairs(spark, sf)
    return found.agg(F.lit(used).alias("backend_used"), F.count("*").alias("text_pairs"))


def asked(spark, sf):
    """Benchmark texts, prepared like the corpus and with its lemmas."""
    items = views.table(spark, sf, "benchmark").withColumn("normalised_text", T.normalise_text(F.col("text")))
    ready = preprocess.preprocess_signals(items, lemma=corpus_lemmas(spark, sf), key="item_id")
    return ready.select("item_id", "preprocessed_text")


ASKED = (
    f"asked AS (SELECT item_id, {C.normalise('text')} AS normalised_text FROM benchmark)",
    f"""asked_terms AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest({C.feature_terms(
      "array_to_string(list_transform(" + C.kept_tokens(C.word_list('normalised_text')) + ", lambda w: coalesce(m[w], w)), ' ')")}) AS term
 FROM asked, lemma_map) GROUP BY 1, 2)""",
    """asked_weights AS (SELECT item_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS w
 FROM (SELECT item_id, t.term, tf * idf AS raw FROM asked_terms t JOIN idf i ON t.term = i.term))""",
    f"""near AS (SELECT item_id, m.signal_id, m.category, s.units, row_number() OVER (PARTITION BY item_id
 ORDER BY s.units DESC, m.signal_id) AS rank FROM (SELECT item_id, key, {C.units('sum(a.w * w.w)')} AS units
 FROM asked_weights a JOIN weights w ON a.term = w.term GROUP BY 1, 2) s JOIN members m USING (key))""",
)


@query(
    "q_j13_top_k_similar",
    C.with_(*CORPUS, *VECTORS, *ASKED)
    + "SELECT item_id, signal_id, units / 10000::DOUBLE AS similarity, CAST(rank AS INTEGER) AS rank FROM near WHERE rank <= 5",
)
def j13(spark, sf):
    return similarity.top_k_similar(asked(spark, sf), corpus_index(spark, sf), 5)


@query(
    "q_c11_group_hint",
    C.recursive(*CORRELATED, *ASKED, f"member_rows AS ({MEMBERS})")
    + """SELECT n.item_id, n.signal_id, m.group_id, coalesce(m.predicted_category, n.category) AS related_category
 FROM near n LEFT JOIN member_rows m USING (signal_id) WHERE n.rank = 1""",
)
def c11(spark, sf):
    best = similarity.top_k_similar(asked(spark, sf), corpus_index(spark, sf), 1)
    found = correlate.group_hint(best, correlated(spark, sf), prepared(spark, sf))
    return found.select("item_id", "signal_id", "group_id", "related_category")


_DIST = """, pair_rows AS MATERIALIZED (SELECT c.incident_group IS NOT DISTINCT FROM d.incident_group AS same,
  coalesce(p.cosine, 0.0) AS cosine
 FROM (SELECT c.*, t.key FROM corpus c JOIN texts t ON c.preprocessed_text = t.t) c
 JOIN (SELECT c.*, t.key FROM corpus c JOIN texts t ON c.preprocessed_text = t.t) d ON c.signal_id < d.signal_id
 LEFT JOIN (SELECT * FROM text_pairs UNION ALL SELECT DISTINCT key, key, 1.0 FROM weights) p
  ON p.key_a = least(c.key, d.key) AND p.key_b = greatest(c.key, d.key))"""


@query(
    "q_a15_pair_score_distribution",
    ON_TEXTS
    + _DIST
    + f"""SELECT CASE WHEN same THEN 'Same Incident' ELSE 'Cross Incident' END AS pair_type,
 count(*) AS pairs, {C.rnd('avg(cosine)')} AS mean_score,
 count(*) FILTER (cosine >= 0.25) AS above_25, count(*) FILTER (cosine >= 0.5) AS above_50,
 count(*) FILTER (cosine >= 0.75) AS above_75 FROM pair_rows GROUP BY same""",
)
def a15(spark, sf):
    found = counted_distribution(prepared(spark, sf), counted_pairs(spark, sf), PAIR_LEVELS)
    return narrow_counts(found, "pairs", "above_25", "above_50", "above_75")


# --- time window and gates -------------------------------------------------------


@query(
    "q_j7_time_window_pairs",
    C.with_(C.EVENT)
    + """SELECT a.source_type, count(*) AS pairs FROM event_signals a JOIN event_signals b
 ON a.source_type = b.source_type AND a.signal_id < b.signal_id
 AND abs(epoch_us(a.timestamp) - epoch_us(b.timestamp)) <= 1800000000 GROUP BY 1""",
)
def j7(spark, sf):
    df = views.signals(spark, sf, "event_signals")
    return narrow_counts(timewindow.window_pair_counts(df, ["source_type"]), "pairs")


@query(
    "q_j7_window_edges",
    C.with_(C.EVENT)
    + """SELECT a.category, epoch_us(least(a.timestamp, b.timestamp)) // 1800000000 AS early,
 epoch_us(greatest(a.timestamp, b.timestamp)) // 1800000000 AS late, count(*) AS pairs
 FROM event_signals a JOIN event_signals b ON a.category = b.category AND a.signal_id < b.signal_id
 AND abs(epoch_us(a.timestamp) - epoch_us(b.timestamp)) <= 1800000000 GROUP BY 1, 2, 3""",
)
def j7_edges(spark, sf):
    return narrow_counts(timewindow.cell_edges(views.signals(spark, sf, "event_signals"), ["category"]), "pairs")


@query(
    "q_j9_category_agreement",
    C.with_(C.EVENT, C.predictions("event_signals"))
    + """SELECT a.predicted_category, count(*) AS pairs FROM (SELECT * FROM event_signals
  JOIN predictions USING (signal_id)) a JOIN (SELECT * FROM event_signals JOIN predictions USING (signal_id)) b
 ON a.predicted_category = b.predicted_category AND a.signal_id < b.signal_id
 AND abs(epoch_us(a.timestamp) - epoch_us(b.timestamp)) <= 1800000000 GROUP BY 1""",
)
def j9(spark, sf):
    df = views.signals(spark, sf, "event_signals")
    both = df.join(views.predictions(df).select("signal_id", "predicted_category"), "signal_id")
    return narrow_counts(timewindow.window_pair_counts(both, ["predicted_category"]), "pairs")


@query(
    "q_j10_gated_pairs",
    ON_EDGES
    + """SELECT predicted_category, key_a AS signal_a, key_b AS signal_b, units / 10000::DOUBLE AS similarity,
 count(*) AS pairs FROM edges GROUP BY 1, 2, 3, 4""",
)
def j10(spark, sf):
    links = correlated(spark, sf).links
    return narrow_counts(correlate.gated_pairs(links, similarity.text_members(prepared(spark, sf))), "pairs")


@query(
    "q_j10_dense_gated_pairs",
    C.with_(*DENSE, *edges())
    + """SELECT predicted_category, key_a AS signal_a, key_b AS signal_b, units / 10000::DOUBLE AS similarity,
 count(*) AS pairs FROM edges GROUP BY 1, 2, 3, 4""",
)
def j10_dense(spark, sf):
    members = similarity.members_of(prepared_vectors(spark, sf), similarity.vector_key())
    return narrow_counts(correlate.gated_pairs(correlated_vectors(spark, sf).links, members), "pairs")


@query(
    "q_c1_gate_edges",
    ON_EDGES
    + f"""SELECT predicted_category, count(*) AS edges, {C.mean_units('CAST(sum(units) AS BIGINT)', 'count(*)')}
 AS avg_similarity FROM edges GROUP BY 1""",
)
def c1(spark, sf):
    links = correlated(spark, sf).links
    rows = correlate.gated_pairs(links, similarity.text_members(prepared(spark, sf)))
    units = to_units(F.col("similarity")).cast("decimal(9,0)") * F.col("pairs")
    summed = rows.groupBy("predicted_category").agg(
        F.sum("pairs").alias("edges"), mean_of_units(F.sum(units), F.sum("pairs")).alias("avg_similarity")
    )
    return narrow_counts(summed, "edges")


# --- groups ----------------------------------------------------------------------


@query("q_c10_correlate_signals", ON_GROUPS + f"SELECT {GROUP_COLUMNS} FROM ranked")
def c10(spark, sf):
    return flat(correlated(spark, sf).groups)


@query(
    "q_c10_dense_correlation",
    C.recursive(*DENSE, *edges(), *COMPONENTS, *HEADERS) + f"SELECT {GROUP_COLUMNS} FROM ranked",
)
def c10_dense(spark, sf):
    return flat(correlated_vectors(spark, sf).groups)


@query(
    "q_c2_connected_components",
    C.recursive(*CORPUS, *VECTORS, *edges(), *COMPONENTS) + "SELECT signal_id, root AS component FROM labels",
)
def c2(spark, sf):
    members = correlated(spark, sf).members().select("group_id", "signal_id")
    roots = members.groupBy("group_id").agg(F.min("signal_id").alias("component"))
    return members.join(roots, "group_id").select("signal_id", "component")


@query(
    "q_c3_drop_singletons",
    ON_GROUPS + "SELECT root AS component, count(*) AS signals FROM labels GROUP BY 1 HAVING count(*) > 1",
)
def c3(spark, sf):
    return (
        correlated(spark, sf).members()
        .groupBy("group_id")
        .agg(F.min("signal_id").alias("component"), F.count("*").alias("signals"))
        .filter("signals > 1")
        .select("component", "signals")
    )


@query(
    "q_j12_singleton_signals",
    ON_GROUPS + "SELECT signal_id FROM corpus WHERE signal_id NOT IN (SELECT signal_id FROM labels)",
)
def j12(spark, sf):
    grouped = correlated(spark, sf).members().select("signal_id")
    return prepared(spark, sf).select("signal_id").join(grouped, "signal_id", "left_anti")


@query("q_c4_avg_similarity", ON_GROUPS + "SELECT group_id, avg_similarity FROM ranked")
def c4(spark, sf):
    return correlated(spark, sf).groups.select("group_id", "avg_similarity")


@query(
    "q_c5_group_attributes",
    ON_GROUPS
    + """SELECT group_id, predicted_category, signal_count, source_types, time_span_minutes, max_anomaly_score
 FROM ranked""",
)
def c5(spark, sf):
    return flat(correlated(spark, sf).groups).drop("avg_similarity", "confidence_score")


@query(
    "q_c6_signals_detail",
    ON_GROUPS + f"SELECT group_id, signal_id, source_type, left(text, 80) AS text_snippet FROM ({MEMBERS})",
)
def c6(spark, sf):
    return correlated(spark, sf).members().select("group_id", "signal_id", "source_type", "text_snippet")


@query("q_c7_group_confidence", ON_GROUPS + "SELECT group_id, confidence_score FROM ranked")
def c7(spark, sf):
    return correlated(spark, sf).groups.select("group_id", "confidence_score")


@query("q_c8_group_rank", ON_GROUPS + "SELECT r AS rank, group_id, first_id AS first_signal FROM ranked")
def c8(spark, sf):
    return correlated(spark, sf).groups.select(
        "rank", "group_id", F.col("first_signal.signal_id").alias("first_signal")
    )


@query(
    "q_c12_top_groups",
    ON_GROUPS
    + f"""SELECT group_id, signal_id, source_type, left(text, 80) AS text_snippet FROM ({MEMBERS})
 WHERE group_id IN ('CORR-001', 'CORR-002', 'CORR-003')""",
)
def c12(spark, sf):
    found = correlated(spark, sf)
    top = found.groups.filter("rank <= 3").select("group_id")
    return (
        found.members()
        .join(top, "group_id", "left_semi")
        .select("group_id", "signal_id", "source_type", "text_snippet")
    )


_SHOWN = ("Network Outage", "Security Breach")


@query(
    "q_c13_feed_view",
    ON_GROUPS
    + f"""SELECT g.group_id, g.confidence_score, g.signal_id, g.source_type, g.text_snippet, g.avg_similarity, t.incidents
 FROM (SELECT r.group_id, r.confidence_score, m.signal_id, m.source_type, left(m.text, 80) AS text_snippet,
  r.avg_similarity FROM grouped m JOIN ranked r USING (root)
  WHERE r.predicted_category IN {_SHOWN}) g
 JOIN (SELECT r.group_id, count(DISTINCT m.incident_group) AS incidents FROM grouped m JOIN ranked r USING (root)
  GROUP BY 1) t USING (group_id)""",
)
def c13(spark, sf):
    return correlate.feed(correlated(spark, sf), _SHOWN)


@query(
    "q_v5_category_filter",
    ON_GROUPS + f"SELECT group_id, predicted_category FROM ranked WHERE predicted_category IN {_SHOWN}",
)
def v5(spark, sf):
    return reports.in_categories(correlated(spark, sf).groups, _SHOWN).select("group_id", "predicted_category")


@query(
    "q_j11_semi_join",
    ON_GROUPS + "SELECT incident_group, count(*) AS signals FROM corpus WHERE signal_id IN (SELECT signal_id FROM labels) GROUP BY 1",
)
def j11(spark, sf):
    grouped = correlated(spark, sf).members().select("signal_id")
    return (
        prepared(spark, sf)
        .join(grouped, "signal_id", "left_semi")
        .groupBy("incident_group")
        .agg(F.count("*").alias("signals"))
    )


_AVERAGES = f"""{C.mean_units(f"CAST(sum({C.units('confidence_score')}) AS BIGINT)", 'count(*)')} AS avg_confidence_score,
 CAST((CAST(sum(signal_count) AS BIGINT) * 200 + count(*)) // (count(*) * 2) AS DOUBLE) / 100 AS avg_group_size,
 CAST((CAST(sum(CAST(round(CAST(time_span_minutes AS DECIMAL(18,9)) * 100, 0) AS BIGINT)) AS BIGINT) * 2
  + count(*)) // (count(*) * 2) AS DOUBLE) / 100 AS avg_time_span_minutes"""


@query(
    "q_a13_group_summary",
    ON_GROUPS
    + f"""SELECT count(*) AS groups, CAST(sum(signal_count) AS BIGINT) AS signals, {_AVERAGES} FROM ranked""",
)
def a13(spark, sf):
    return evaluate.group_averages(correlated(spark, sf).groups)


@query(
    "q_a14_confidence_histogram",
    ON_GROUPS
    + """SELECT predicted_category, CAST(least(floor(confidence_score * 14), 13) AS INTEGER) AS bin,
 count(*) AS groups FROM ranked GROUP BY 1, 2""",
)
def a14(spark, sf):
    return reports.confidence_histogram(correlated(spark, sf).groups)


# --- evaluation ------------------------------------------------------------------


@query(
    "q_j2_truth_lookup",
    C.with_(C.DOC)
    + """SELECT d.signal_id, l.quality, l.quality IS NOT DISTINCT FROM f.quality AS like_first FROM doc_signals d
 LEFT JOIN labels l ON CAST(substr(d.signal_id, 5) AS BIGINT) = l.doc_id
 LEFT JOIN (SELECT incident_group, arg_min(signal_id, signal_id) AS first FROM doc_signals GROUP BY 1) i USING (incident_group)
 LEFT JOIN labels f ON CAST(substr(i.first, 5) AS BIGINT) = f.doc_id""",
)
def j2(spark, sf):
    """Label of a signal against the label of its incident's first signal; two missing labels agree."""
    df = views.signals(spark, sf, "doc_signals").select("signal_id", "incident_group")
    labels = views.table(spark, sf, "labels").select(
        F.concat(F.lit("DOC-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("signal_id"), "quality"
    )
    first = (
        df.groupBy("incident_group")
        .agg(F.min("signal_id").alias("signal_id"))
        .join(labels, "signal_id", "left")
        .select("incident_group", F.col("quality").alias("first_quality"))
    )
    return (
        df.join(labels, "signal_id", "left")
        .join(first, "incident_group", "left")
        .select("signal_id", "quality", F.col("quality").eqNullSafe(F.col("first_quality")).alias("like_first"))
    )


_PAIR_TRUTH = f"""SELECT sum(n) AS total_pairs, sum(n) FILTER (same) AS tp, sum(units * n) FILTER (same) AS u_same,
 sum(n) FILTER (NOT same) AS fp, sum(units * n) FILTER (NOT same) AS u_diff FROM (SELECT
 {C.units('p.cosine')} AS units, a.incident_group IS NOT DISTINCT FROM b.incident_group AS same, 1 AS n
 FROM (SELECT * FROM text_pairs UNION ALL SELECT DISTINCT key, key, 1.0 FROM weights) p
 JOIN members a ON a.key = p.key_a JOIN members b ON b.key = p.key_b AND (p.key_a <> p.key_b OR a.signal_id < b.signal_id)
 WHERE cosine >= 0.25)"""


@query(
    "q_e4_similarity_evaluation",
    ON_TEXTS
    + f"""SELECT CAST(total_pairs AS BIGINT) AS total_pairs, CAST(coalesce(tp, 0) AS BIGINT) AS true_positives,
 CAST(coalesce(fp, 0) AS BIGINT) AS false_positives, {C.ratio('coalesce(tp, 0)', 'total_pairs')} AS precision,
 {C.mean_units('CAST(coalesce(u_same, 0) AS BIGINT)', 'CAST(coalesce(tp, 0) AS BIGINT)')} AS avg_score_same_incident,
 {C.mean_units('CAST(coalesce(u_diff, 0) AS BIGINT)', 'CAST(coalesce(fp, 0) AS BIGINT)')} AS avg_score_diff_incident
 FROM ({_PAIR_TRUTH})""",
)
def e4(spark, sf):
    found = evaluate.evaluate_counted_pairs(counted_pairs(spark, sf), prepared(spark, sf))
    return narrow_counts(found, "total_pairs", "true_positives", "false_positives")


def _group_truth(labels: str) -> str:
    """Pair counting by listing the pairs, the plain way."""
    return f"""(SELECT count(*) AS total_groups, count(*) FILTER (k = 1) AS perfect_groups,
  count(*) FILTER (k > 1) AS fragmented_groups, CAST(coalesce(sum(s), 0) AS BIGINT) AS signals_in_groups
  FROM (SELECT root, count(DISTINCT incident_group) AS k, count(*) AS s FROM {labels} GROUP BY 1)),
 (SELECT CAST(count(*) AS DOUBLE) AS said, CAST(count(*) FILTER (a.incident_group = b.incident_group) AS DOUBLE) AS hit
  FROM {labels} a JOIN {labels} b ON a.root = b.root AND a.signal_id < b.signal_id),
 (SELECT CAST(count(*) AS DOUBLE) AS true_pairs FROM corpus a JOIN corpus b
  ON a.incident_group = b.incident_group AND a.signal_id < b.signal_id)"""


_P = "CASE WHEN said > 0 THEN hit / said ELSE 0 END"
_R = "CASE WHEN true_pairs > 0 THEN hit / true_pairs ELSE 0 END"
_GROUP_METRICS = f"""{C.rnd(_P)} AS precision, {C.rnd(_R)} AS recall,
 {C.rnd(f'CASE WHEN hit > 0 THEN 2 * ({_P}) * ({_R}) / (({_P}) + ({_R})) ELSE 0 END')} AS f1"""


@query(
    "q_e5_correlation_evaluation",
    ON_GROUPS
    + f"""SELECT total_groups, perfect_groups, fragmented_groups, signals_in_groups, {_GROUP_METRICS}, v.*
 FROM {_group_truth('grouped')}, (SELECT {_AVERAGES} FROM ranked) v""",
)
def e5(spark, sf):
    found = correlated(spark, sf)
    return evaluate.evaluate_correlation(found.members(), found.groups, prepared(spark, sf))


@query(
    "q_e6_mixed_groups",
    ON_GROUPS
    + f"""SELECT group_id, count(DISTINCT incident_group) AS incidents FROM ({MEMBERS}) GROUP BY 1
 HAVING count(DISTINCT incident_group) > 1""",
)
def e6(spark, sf):
    return evaluate.mixed_groups(correlated(spark, sf).members())


THRESHOLDS = (0.5, 0.35, 0.25)


def _sweep_sql(t: float) -> tuple[str, ...]:
    n = str(int(t * 100))
    return (
        f"ways{n} AS (SELECT a, b FROM edges WHERE cosine >= {t} UNION SELECT b, a FROM edges WHERE cosine >= {t})",
        f"reach{n}(n, root) AS (SELECT a, a FROM ways{n} UNION SELECT w.b, r.root FROM reach{n} r JOIN ways{n} w ON w.a = r.n)",
        f"labels{n} AS MATERIALIZED (SELECT n AS signal_id, min(root) AS root FROM reach{n} GROUP BY 1)",
        f"grouped{n} AS (SELECT m.*, l.root FROM members m JOIN labels{n} l USING (signal_id))",
    )


@query(
    "q_e7_threshold_sweep",
    C.recursive(*CORPUS, *VECTORS, *edges(), *(cte for t in THRESHOLDS for cte in _sweep_sql(t)))
    + " UNION ALL ".join(
        f"""SELECT {t}::DOUBLE AS threshold, total_groups, signals_in_groups, {_GROUP_METRICS}
 FROM {_group_truth('grouped' + str(int(t * 100)))}"""
        for t in THRESHOLDS
    ),
)
def e7(spark, sf):
    return correlate.threshold_sweep(correlated(spark, sf).links, prepared(spark, sf), THRESHOLDS).select(
        "threshold", "total_groups", "signals_in_groups", "precision", "recall", "f1"
    )


_LABELLED = C.with_(C.DOC, C.predictions("doc_signals")) + """, labelled AS (SELECT d.category AS actual,
 p.predicted_category AS predicted FROM doc_signals d JOIN predictions p USING (signal_id)),
 spine AS (SELECT a.c AS actual, b.c AS predicted FROM (SELECT unnest([{c}]) AS c) a, (SELECT unnest([{c}]) AS c) b),
 confusion AS (SELECT s.actual, s.predicted, count(l.actual) AS n FROM spine s LEFT JOIN labelled l
  ON s.actual = l.actual AND s.predicted = l.predicted GROUP BY 1, 2),
 counts AS (SELECT c, CAST(sum(n) FILTER (actual = c) AS BIGINT) AS support,
  CAST(coalesce(sum(n) FILTER (actual = c AND predicted = c), 0) AS DOUBLE) AS hits,
  CAST(sum(n) FILTER (predicted = c) AS DOUBLE) AS claimed
  FROM confusion, (SELECT unnest([{c}]) AS c) GROUP BY 1),
 pr AS (SELECT c, support, hits, CASE WHEN claimed > 0 THEN hits / claimed ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM counts),
 prf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)
 """.format(c=C.CATEGORY_LIST)


def labelled(spark, sf):
    df = views.signals(spark, sf, "doc_signals").select("signal_id", "category")
    return df.join(views.predictions(df).select("signal_id", "predicted_category"), "signal_id")


@query(
    "q_e1_classifier_metrics",
    _LABELLED
    + f"""SELECT {C.rnd('sum(hits) / sum(support)')} AS accuracy, {C.rnd('sum(p * support) / sum(support)')} AS precision,
 {C.rnd('sum(r * support) / sum(support)')} AS recall, {C.rnd('sum(f * support) / sum(support)')} AS f1 FROM prf""",
)
def e1(spark, sf):
    return evaluate.evaluate_classifier(labelled(spark, sf))


@query("q_e2_confusion_matrix", _LABELLED + "SELECT actual, predicted, n FROM confusion")
def e2(spark, sf):
    return evaluate.confusion_counts(labelled(spark, sf))


@query(
    "q_e3_class_report",
    _LABELLED
    + f"""SELECT c AS category, {C.rnd('p')} AS precision, {C.rnd('r')} AS recall, {C.rnd('f')} AS f1, support FROM prf
 UNION ALL SELECT 'macro avg', {C.rnd('avg(p)')}, {C.rnd('avg(r)')}, {C.rnd('avg(f)')}, CAST(sum(support) AS BIGINT) FROM prf
 UNION ALL SELECT 'weighted avg', {C.rnd('sum(p * support) / sum(support)')}, {C.rnd('sum(r * support) / sum(support)')},
 {C.rnd('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM prf""",
)
def e3(spark, sf):
    return evaluate.class_report(labelled(spark, sf))
