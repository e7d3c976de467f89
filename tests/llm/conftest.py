import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGE_TEXTS = [None, "", "  \n\t ", "a", "same words here again and again", "same words here again and again", "é ß\n\nñ", "x" * 5000]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty, blank, tiny, repeated and long texts, null numbers, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", "s", len(t) if t else None) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(3, "a", "en", "s", 1), (None, "no number here", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    from pyspark.sql import functions as F

    clashing = ("row", "key", "n", "h", "bytes", "score", "rule", "y", "_id", "good", "stratum", "depth", "prefix")
    return df.select("*", *[F.lit("clash").alias(c) for c in clashing])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
