"""TF-IDF as tables: term counts, document frequencies, fitted vocabularies, text vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.text import feature_terms, ngrams
from opsignal.session import materialise


#: Occurrences of chosen terms that a task counts by key, on average.
MET_PER_TASK = 1 << 20
#: Terms of neighbouring texts counted together in a task.
TERMS_AT_ONCE = 1 << 18


def term_counts(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """``(key, term, tf)``. All terms of a row sit in one task, so most counting is map-side."""
    return (
        df.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))
    )


def smooth_idf(n: Column, df: Column) -> Column:
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + F.lit(1.0)


def sublinear(tf: Column) -> Column:
    return F.lit(1.0) + F.log(tf.cast("double"))


def document_frequency(met: DataFrame, key: str) -> DataFrame:
    """``(term, df)``: by how many keys a term is met."""
    return met.select(key, "term").distinct().groupBy("term").agg(F.count("*").alias("df"))


def row_count(df: DataFrame) -> DataFrame:
    """One row ``n``."""
    return df.agg(F.count("*").alias("n"))


def unit_weights(postings: DataFrame, key: str, raw: Column) -> DataFrame:
    """``(key, term, weight)`` with each key's weights scaled to length one.

    One text's terms share a partition: the group is bounded by the text.
    """
    whole = Window.partitionBy(key)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(whole))
    return postings.withColumn("_raw", raw).select(key, "term", (F.col("_raw") / norm).alias("weight"))


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary ``(term, idx, idf)`` of at most ``max_features`` rows."""

    vocab: DataFrame
    max_ngram: int


def _class_terms(text_column: str, max_ngram: int) -> Column:
    return ngrams(feature_terms(F.col(text_column)), max_ngram)


def _met_terms(
    df: DataFrame, chosen: DataFrame, text_column: str, key: str, max_ngram: int, parts: int | None = None
) -> DataFrame:
    """``(key, *chosen)`` for every occurrence of a chosen term.

    Texts are dealt by ``key`` while whole, so that counting by key and term moves nothing more,
    into so many ``parts`` if given: else into parts of so many bytes, whatever they hold of terms.
    """
    whole = df.select(key, text_column)
    whole = whole.repartition(F.col(key)) if parts is None else whole.repartition(parts, F.col(key))
    # The outer form keeps the optimizer from repeating the tokeniser in a filter.
    exploded = whole.select(key, F.explode_outer(_class_terms(text_column, max_ngram)).alias("term"))
    # The vocabulary is capped at max_features rows, a proven bound.
    return exploded.join(F.broadcast(chosen), "term")


def tfidf_fit(
    df: DataFrame, text_column: str = "preprocessed_text", key: str = "signal_id", cfg: Config = DEFAULT
) -> TfidfModel:
    """Classifier vocabulary: the ``max_features`` most frequent terms, fitted on ``df`` only."""
    # Totals need no keys; documents are counted for the chosen terms only.
    terms = df.select(F.explode_outer(_class_terms(text_column, cfg.max_ngram)).alias("term")).filter("term IS NOT NULL")
    totals = terms.groupBy("term").agg(F.count("*").alias("total"))
    chosen = materialise(totals.orderBy(F.desc("total"), "term").limit(cfg.max_features), "chosen")
    # The totals say how many occurrences are counted by key, so that no task holds too many.
    met = chosen.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-met // MET_PER_TASK))
    capped = document_frequency(_met_terms(df, chosen.select("term"), text_column, key, cfg.max_ngram, parts), key)
    # At most max_features rows reach this window.
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("term")) - 1
    vocab = capped.join(F.broadcast(row_count(df)), F.lit(True)).select(
        "term", position.alias("idx"), smooth_idf(F.col("n"), F.col("df")).alias("idf")
    )
    return TfidfModel(vocab, cfg.max_ngram)


def known_terms(df: DataFrame, model: TfidfModel | None, text_column: str, key: str) -> DataFrame:
    """``(key, idx, term, raw)`` for terms of the vocabulary; others drop out map-side."""
    if model is None:
        raise ValueError("transform needs a fitted vocabulary")
    met = _met_terms(df, model.vocab, text_column, key, model.max_ngram)
    counted = met.groupBy(key, "term", "idx", "idf").agg(F.count("*").alias("tf"))
    return counted.select(key, "idx", "term", (sublinear(F.col("tf")) * F.col("idf")).alias("raw"))


def tfidf_transform(
    df: DataFrame,
    model: TfidfModel | None,
    text_column: str = "preprocessed_text",
    key: str = "signal_id",
) -> DataFrame:
    """``(key, term, weight)``; a text without known terms has no rows (a zero vector)."""
    known = known_terms(df, model, text_column, key)
    return unit_weights(known, key, F.col("raw"))


def text_postings(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(key, copies, term, tf)`` of the distinct texts.

    Copies of a text are counted before anything is tokenised, so a text that makes
    up a third of the corpus costs as much as one signal.
    """
    texts = (
        df.groupBy(F.col(text_column).alias("_text"))
        .agg(F.count("*").alias("copies"))
        .select(F.md5("_text").alias("key"), "copies", feature_terms(F.col("_text")).alias("_terms"))
    )
    # A text is one row, so its terms are counted where it is.
    return texts.mapInArrow(_counted, "key string, copies bigint, term string, tf bigint")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, copies, term, tf)`` of rows ``(key, copies, _terms)``, some neighbouring rows at a time."""
    for batch in batches:
        size = batch.column("_terms").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        before = np.cumsum(size) - size
        for part in np.split(np.arange(len(size)), np.flatnonzero(np.diff(before // TERMS_AT_ONCE)) + 1):
            if not len(part):
                continue
            rows = batch.slice(part[0], len(part))
            row = pa.array(np.repeat(np.arange(len(part)), size[part]))
            terms = pa.table({"row": row, "term": rows.column("_terms").flatten()})
            met = terms.group_by(["row", "term"]).aggregate([([], "count_all")])
            yield from pa.table(
                {
                    "key": rows.column("key").take(met["row"].combine_chunks()),
                    "copies": rows.column("copies").take(met["row"].combine_chunks()),
                    "term": met["term"],
                    "tf": met["count_all"],
                }
            ).to_batches()


def similarity_weights(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(key, copies, term, raw, df, idf)``: raw tf times smooth idf over the whole corpus.

    Document frequencies weigh each text by its copies and ``n`` counts every signal.
    The postings are written once and read by both sides of the join, which is a
    merge join: postings are far larger than the planner can tell from the texts.
    """
    postings = materialise(text_postings(df, text_column), "postings", "zstd")
    frequency = postings.groupBy("term").agg(F.sum("copies").alias("df"))
    idf = frequency.join(F.broadcast(row_count(df)), F.lit(True)).select(
        "term", "df", smooth_idf(F.col("n"), F.col("df")).alias("idf")
    )
    # The key travels as its 16 bytes.
    short = postings.withColumn("key", F.unhex("key"))
    return short.hint("merge").join(idf, "term").select(
        F.lower(F.hex("key")).alias("key"), "copies", "term", (F.col("tf") * F.col("idf")).alias("raw"), "df", "idf"
    )


def corpus_idf(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(term, df, idf)`` of a corpus, for weighting texts from outside it.

    Every signal counts once for each of its terms, so that no text moves and copies need not be found.
    """
    met = df.select(F.explode(F.array_distinct(feature_terms(F.col(text_column)))).alias("term"))
    frequency = met.groupBy("term").agg(F.count("*").alias("df"))
    return frequency.join(F.broadcast(row_count(df)), F.lit(True)).select(
        "term", "df", smooth_idf(F.col("n"), F.col("df")).alias("idf")
    )


def similarity_tfidf(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(key, term, weight)`` of the distinct texts."""
    return unit_weights(similarity_weights(df, text_column), "key", F.col("raw"))


def unit_vectors(df: DataFrame, text_column: str = "preprocessed_text") -> DataFrame:
    """``(key, copies, ids, ws)``: one row per distinct text with terms, terms as their 64-bit hashes in order."""
    # A term travels as its 64-bit hash, a key as its 16 bytes; single rows are shorter than lists of one or two.
    raw = similarity_weights(df, text_column)
    raw = raw.select(F.unhex("key").alias("_key"), "copies", F.xxhash64("term").alias("id"), "raw").repartition("_key")
    entry = F.sort_array(F.collect_list(F.struct("id", "raw")))
    square = F.sum(F.col("raw") * F.col("raw"))
    texts = raw.groupBy("_key", "copies").agg(entry.alias("_all"), square.alias("_square"))
    return texts.select(
        F.lower(F.hex("_key")).alias("key"),
        "copies",
        F.col("_all.id").alias("ids"),
        F.transform("_all.raw", lambda w: w / F.sqrt("_square")).alias("ws"),
    )


def text_vectors(df: DataFrame, threshold: float, text_column: str = "preprocessed_text") -> DataFrame:
    """One row per distinct text with terms: its unit vector and its searchable prefix.

    Terms are ordered from rare to common, the same for all texts. Every term of a text carries
    ``upto``, the length of the text's part from that term on, and ``rest``, that of the part
    behind it. The first term two texts share is followed by all others they share, so their
    cosine is at most ``upto_a * upto_b`` there: a term whose ``upto`` is below the threshold can
    be no first shared term of a similar pair. The *prefix* holds the other terms; the most common
    ones, the hot join keys, stay out of it.
    """
    if threshold <= 0:
        raise ValueError("a prefix needs a threshold above 0: below, texts without a shared term belong to the result")
    # From here on a term is its 64-bit hash, which keeps the shuffled rows short.
    raw = similarity_weights(df, text_column).select("key", "copies", "df", F.xxhash64("term").alias("id"), "raw")
    # One text's terms share a partition: the group is bounded by the text.
    text = Window.partitionBy("key")
    common = text.orderBy(F.desc("df"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("raw") * F.col("raw")
    measured = raw.select(
        "key", "copies", "id", "raw", F.sum(square).over(common).alias("_upto"), F.sum(square).over(text).alias("_total")
    )
    entry = F.struct(
        "id",
        (F.col("raw") / F.sqrt("_total")).alias("w"),
        F.sqrt(F.col("_upto") / F.col("_total")).alias("upto"),
        F.sqrt(F.greatest((F.col("_upto") - square) / F.col("_total"), F.lit(0.0))).alias("rest"),
    )
    terms = measured.groupBy("key", "copies").agg(F.sort_array(F.collect_list(entry)).alias("_all"))
    return terms.select(
        "key",
        "copies",
        F.col("_all.id").alias("ids"),
        F.col("_all.w").alias("ws"),
        F.filter("_all", lambda t: t["upto"] >= F.lit(threshold - 1e-9)).alias("prefix"),
    )
