"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsignal.llm import (
    checksql, convtrie, decontam, jaccard, langid, linededup, packing, quality, recompress, resample, secrets, sharding, toxicity, urlrules,
)
from opsignal.llm.common import remainder, table

SHARD_BYTES = 16 << 20
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extendible hashing of all documents into shards of at most 16 MiB."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all documents into sequences of 1024 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.drop("text_row")


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and path templates over all pages; a page counts as bad where ``labels`` calls its number so."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return urlrules.judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def language_model(spark: SparkSession, sf_dir: str) -> langid.Model:
    """Learnt from rows of ``documents`` whose remainder is not 1."""
    docs = table(spark, sf_dir, "documents")
    return langid.fit(docs.filter(remainder("doc_id", 3) != 1))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = langid.predict(docs, language_model(spark, sf_dir))
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated runs of lines of 50 words and more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items found in documents, with their alignment scores."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents, a stratum per language."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels whose remainder is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0).select("doc_id", "toxic")
    model = toxicity.fit(docs, marks)
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "spans")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 35 words and more that stand twice."""
    found = recompress.dedup_substrings(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return convtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark; five in a hundred are drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_packing, op3_url_templates, op4_ngram_jaccard, op5_language, op6_line_dedup,
        op7_decontamination, op8_quality_rules, op9_toxicity, op10_secrets, op11_substring_dedup, op12_conversation_trie,
        op13_importance_resampling, pipeline,
    )
}
SQL: dict[str, str] = checksql.SQL
