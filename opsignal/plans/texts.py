"""Queries on text: normalisation rules, tokens, lemmas, vocabulary statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsignal.functions import text as T
from opsignal.functions.stopwords import ENGLISH, INCIDENT_WORDS, domain_stop_words
from opsignal.operators import preprocess
from opsignal.plans import checksql as C
from opsignal.plans.registry import query
from opsignal.session import materialise
from opsignal.sources import views


def events(spark, sf):
    return views.signals(spark, sf, "event_signals")


def docs(spark, sf):
    return views.signals(spark, sf, "doc_signals")


def conversations(spark, sf):
    """A second text source: turns with their line breaks."""
    return views.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("CONV"), "conv_id", "turn").alias("signal_id"), "text"
    )


CONV = """conv AS (SELECT concat_ws('-', 'CONV', CAST(conv_id AS STRING), CAST(turn AS STRING)) AS signal_id,
 text FROM conversations)"""
EVENT = C.with_(C.EVENT)


def normalised(df):
    return df.withColumn("normalised_text", T.normalise_text(F.col("text")))


def lemmas_of(df):
    return preprocess.lemma_table(preprocess.vocabulary(preprocess.with_tokens(df)))


def prepared_docs(spark, sf):
    """Document signals through the whole text chain, corpus lemmas included.

    The tokens are written once: the lemma table and its application both read them.
    """
    tokens = materialise(preprocess.with_tokens(normalised(docs(spark, sf))).select("signal_id", "tokens"), "tokens")
    spelt = preprocess.with_lemmas(tokens, preprocess.lemma_table(preprocess.vocabulary(tokens)))
    return spelt.withColumn("preprocessed_text", F.array_join("tokens", " "))


def _rule(name, column_rule, sql_rule, lower=True):
    """One text rule over the lower-cased event texts."""
    start = "lower(text)" if lower else "text"

    @query(name, EVENT + f"SELECT signal_id, {sql_rule(start)} AS out FROM event_signals")
    def build(spark, sf):
        col = F.lower("text") if lower else F.col("text")
        return events(spark, sf).select("signal_id", column_rule(col).alias("out"))

    return build


@query(
    "q_n0_as_text",
    "SELECT event_id, coalesce(CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS STRING), 'None')"
    " AS out FROM events",
)
def n0(spark, sf):
    holey = F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("user_id"))
    return views.table(spark, sf, "events").select("event_id", T.as_text(holey).alias("out"))


_rule("q_n1_lower", lambda c: c, lambda t: t)
_rule("q_n2_strip_log_level", T.strip_log_level, C.strip_level)
_rule("q_n3_percent", T.mask_percent, C.mask_percent)
_rule("q_n4_clock_time", T.mask_clock, C.mask_clock)
_rule("q_n5_version", T.mask_version, C.mask_version)
_rule("q_n6_ip_address", T.mask_ip, C.mask_ip)
_rule("q_n7_long_integer", T.mask_long_int, C.mask_long_int)
_rule("q_n9_drop_special", T.drop_special, C.drop_special)
_rule("q_n10_squeeze", T.squeeze, C.squeeze)


@query(
    "q_n8_exception",
    r"""SELECT event_id, regexp_replace(concat('Got ', upper(left(event_type, 1)), substr(event_type, 2),
 'Exception in ', event_type, 'Error'), '\b[A-Z][a-zA-Z]+(?:Exception|Error)\b', 'EXCEPTION', 'g') AS out
 FROM events""",
)
def n8(spark, sf):
    said = F.concat(
        F.lit("Got "), F.initcap("event_type"), F.lit("Exception in "), F.col("event_type"), F.lit("Error")
    )
    return views.table(spark, sf, "events").select("event_id", T.mask_exception(said).alias("out"))


@query(
    "q_n11_normalise_text",
    EVENT + f"SELECT signal_id, {C.normalise('text')} AS normalised_text FROM event_signals",
)
def n11(spark, sf):
    return events(spark, sf).select("signal_id", T.normalise_text(F.col("text")).alias("normalised_text"))


@query(
    "q_n11_normalise_long_text",
    C.with_(C.DOC) + f"SELECT signal_id, {C.normalise('text')} AS normalised_text FROM doc_signals",
)
def n11_docs(spark, sf):
    return docs(spark, sf).select("signal_id", T.normalise_text(F.col("text")).alias("normalised_text"))


@query(
    "q_n11_normalise_turns",
    C.with_(CONV) + f"SELECT signal_id, {C.normalise('text')} AS normalised_text FROM conv",
)
def n11_turns(spark, sf):
    return conversations(spark, sf).select("signal_id", T.normalise_text(F.col("text")).alias("normalised_text"))


@query(
    "q_n12_normalise_signals",
    EVENT
    + f"""SELECT signal_id, text, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour,
 CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
 (hour(timestamp) BETWEEN 8 AND 17) AND (isodow(timestamp) BETWEEN 1 AND 5) AS is_business_hours,
 {C.SOURCE_WEIGHT.format(c='source_type')} AS source_weight, {C.normalise('text')} AS normalised_text
 FROM event_signals""",
)
def n12(spark, sf):
    return preprocess.normalise_signals(events(spark, sf)).select(
        "signal_id", "text", "timestamp", "hour", "day_of_week", "is_business_hours", "source_weight",
        "normalised_text",
    )


NORM_DOCS = C.with_(C.DOC, C.normalised("doc_signals"))
TOK_EVENTS = (C.EVENT, C.normalised("event_signals"), C.tokenised())
TOK_DOCS = (C.DOC, C.normalised("doc_signals"), C.tokenised())


@query(
    "q_k1_words",
    NORM_DOCS + f"SELECT signal_id, array_to_string({C.word_list('normalised_text')}, '|') AS words FROM normalised",
)
def k1(spark, sf):
    return normalised(docs(spark, sf)).select(
        "signal_id", F.array_join(T.words(F.col("normalised_text")), "|").alias("words")
    )


@query(
    "q_k2_marker_tokens",
    C.with_(*TOK_EVENTS)
    + f"""SELECT signal_id, array_to_string(list_filter({C.word_list('normalised_text')},
 lambda w: w IN ({C._MARKS})), '|') AS markers FROM normalised""",
)
def k2(spark, sf):
    marks = F.filter(T.words(F.col("normalised_text")), lambda w: w.isin(*T.MARKERS))
    return normalised(events(spark, sf)).select("signal_id", F.array_join(marks, "|").alias("markers"))


@query(
    "q_k3_drop_short",
    NORM_DOCS
    + f"""SELECT signal_id, CAST(len(list_filter({C.word_list('normalised_text')}, lambda w: length(w) > 1))
 AS INTEGER) AS long_words FROM normalised""",
)
def k3(spark, sf):
    kept = T.keep_words(T.words(F.col("normalised_text")), stop_words=[])
    return normalised(docs(spark, sf)).select("signal_id", F.size(kept).alias("long_words"))


@query(
    "q_k4_stop_words_met",
    C.with_(*TOK_DOCS)
    + f"""SELECT w AS word, count(*) AS n FROM (SELECT unnest({C.word_list('normalised_text')}) AS w
 FROM normalised) WHERE w IN ({C._STOPS}) GROUP BY 1""",
)
def k4(spark, sf):
    met = normalised(docs(spark, sf)).select(F.explode(T.words(F.col("normalised_text"))).alias("word"))
    return met.filter(F.col("word").isin(*domain_stop_words())).groupBy("word").agg(F.count("*").alias("n"))


@query(
    "q_k5_stop_word_filter",
    C.with_(*TOK_DOCS) + "SELECT signal_id, array_to_string(tokens, ' ') AS tokens FROM tokenised",
)
def k5(spark, sf):
    return normalised(docs(spark, sf)).select(
        "signal_id", F.array_join(T.tokenise(F.col("normalised_text")), " ").alias("tokens")
    )


@query(
    "q_k6_lemma_table",
    C.with_(*TOK_DOCS, *C.lemma_ctes("SELECT DISTINCT unnest(tokens) AS form FROM tokenised"))
    + "SELECT form, lemma FROM lemmas",
)
def k6(spark, sf):
    return lemmas_of(normalised(docs(spark, sf)))


@query(
    "q_k7_preprocess_signals",
    C.with_(*TOK_DOCS, *C.PREPROCESSED) + "SELECT signal_id, preprocessed_text FROM preprocessed",
)
def k7(spark, sf):
    return prepared_docs(spark, sf).select("signal_id", "preprocessed_text")


@query(
    "q_k7_preprocess_events",
    C.with_(*TOK_EVENTS, *C.PREPROCESSED) + "SELECT signal_id, preprocessed_text FROM preprocessed",
)
def k7_events(spark, sf):
    df = normalised(events(spark, sf))
    return preprocess.preprocess_signals(df, lemma=lemmas_of(df)).select("signal_id", "preprocessed_text")


PRE_EVENTS = C.with_(*TOK_EVENTS, *C.PREPROCESSED)
TOKENS_OF = r"list_filter(regexp_split_to_array(preprocessed_text, '\s+'), lambda w: w <> '')"
PRE_DOCS = C.with_(*TOK_DOCS, *C.PREPROCESSED)


@query(
    "q_k8_token_stats",
    PRE_DOCS
    + f"""SELECT signals, {C.rnd('CAST(total AS DOUBLE) / signals', 2)} AS avg_tokens, min_tokens, max_tokens,
 unique_tokens FROM (SELECT count(*) AS signals, CAST(sum(len({TOKENS_OF})) AS BIGINT) AS total,
  min(len({TOKENS_OF})) AS min_tokens, max(len({TOKENS_OF})) AS max_tokens FROM preprocessed),
 (SELECT count(DISTINCT t) AS unique_tokens FROM (SELECT unnest({TOKENS_OF}) AS t FROM preprocessed))""",
)
def k8(spark, sf):
    return preprocess.token_stats(materialise(prepared_docs(spark, sf), "preprocessed"))


@query(
    "q_k9_top_tokens",
    PRE_DOCS
    + f"""SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS_OF}) AS token FROM preprocessed)
 GROUP BY 1 ORDER BY n DESC, token LIMIT 10""",
)
def k9(spark, sf):
    return preprocess.top_tokens(prepared_docs(spark, sf), 10)


@query(
    "q_k10_marker_counts",
    PRE_EVENTS
    + f"""SELECT m.token, count(t.token) AS n FROM (SELECT unnest([{C._MARKS}]) AS token) m
 LEFT JOIN (SELECT unnest({TOKENS_OF}) AS token FROM preprocessed) t ON m.token = t.token GROUP BY 1""",
)
def k10(spark, sf):
    df = normalised(events(spark, sf))
    return preprocess.marker_counts(preprocess.preprocess_signals(df))


@query(
    "q_k11_feature_terms",
    PRE_EVENTS
    + f"""SELECT signal_id, array_to_string({C.feature_terms('preprocessed_text')}, '|') AS terms
 FROM preprocessed""",
)
def k11(spark, sf):
    df = normalised(events(spark, sf))
    df = preprocess.preprocess_signals(df, lemma=lemmas_of(df))
    return df.select("signal_id", F.array_join(T.feature_terms(F.col("preprocessed_text")), "|").alias("terms"))


@query(
    "q_k12_ngrams",
    C.with_(*TOK_EVENTS)
    + f"""SELECT signal_id, array_to_string(list_concat(tk, list_transform(range(1, greatest(len(tk), 1)),
 lambda i: concat(tk[i], ' ', tk[i + 1]))), '|') AS grams FROM (SELECT signal_id,
 {C.feature_terms("array_to_string(tokens, ' ')")} AS tk FROM tokenised)""",
)
def k12(spark, sf):
    df = preprocess.preprocess_signals(normalised(events(spark, sf)))
    grams = T.ngrams(T.feature_terms(F.col("preprocessed_text")), 2)
    return df.select("signal_id", F.array_join(grams, "|").alias("grams"))


@query(
    "q_u1_stop_word_difference",
    "SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split_regex(text, '[^A-Za-z'']+')) AS w"
    f" FROM benchmark) WHERE lower(w) IN ({C._STOPS})",
)
def u1_words(spark, sf):
    """Domain stop words that the benchmark texts use."""
    used = F.transform(F.split("text", "[^A-Za-z']+"), F.lower)
    stops = F.array_except(
        F.array(*map(F.lit, ENGLISH)), F.array(*map(F.lit, INCIDENT_WORDS))
    )
    return (
        views.table(spark, sf, "benchmark")
        .select(F.explode(F.array_intersect(used, stops)).alias("word"))
        .distinct()
    )
