"""From raw documents to packed training sequences, by operators of ``opsignal.llm``.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns a DataFrame;
all but the last return the columns of documents. ``run`` applies them to the documents table, each
stage's result being written as Parquet to the shared folder and read again.

Documents may have further columns, of any names; they are passed on as they came. Null texts, and
those without a letter, go in the first stage (their language cannot be recognised); empty tables stay
empty. Rows that repeat number and text are copies: one of them stays. Rows with a null number are
never dropped as copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsignal.llm import decontam, jaccard, langid, linededup, packing, queries
from opsignal.llm.common import fresh, materialise, ready, table


def _aside(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, list]:
    """Documents with the columns that an operator would replace under other names, and all columns as they were."""
    names: dict[str, str] = {}
    for c in docs.columns:
        if c.lower() in added:
            names[c] = fresh(f"_{c}", [*docs.columns, *names.values()])
    back = [F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns]
    return docs.toDF(*[names.get(c, c) for c in docs.columns]), back


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` stays as it came."""
    ready(spark)
    docs, back = _aside(docs, ("lang_pred", "score", "rejected"))
    found = langid.predict(docs, queries.language_model(spark, sf_dir))
    return found.filter(~F.col("rejected")).select(*back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the runs of lines that stand earlier; ``n_chars`` follows the text."""
    ready(spark)
    docs, back = _aside(docs, ("n_lines", "n_deleted"))
    found = linededup.dedup_lines(docs)
    n_chars = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*back)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest number, of each class of near copies."""
    ready(spark)
    return jaccard.keep_one(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ready(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    ready(spark)
    return packing.pack_documents(docs, queries.tokenizer_path()).drop("text_row")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("test_items", test_items),
    ("sequences", sequences),
]

#: The stages hold trained models and token merges, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
