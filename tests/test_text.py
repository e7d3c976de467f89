import pytest
from pyspark.sql import functions as F

from opsignal.functions import text as T
from opsignal.functions.stopwords import INCIDENT_WORDS, domain_stop_words
from opsignal.operators import preprocess


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Errors rising", "s rising"),
        (
            "NullPointerException at 10:20:33 from 10.0.0.1 v2.3.1 500ms 1200 users 12.5%",
            "nullpointerexception at TIMEVAL from IPADDR VERVAL 500ms NUMVAL users PCTVAL",
        ),
        ("INFO\nERROR: x", "x"),
        ("ERROR: critical: y", "critical y"),
        ("café déjà 403 — naïve", "café déjà NUMVAL naïve"),
        ("CRITICAL: some important text here", "some important text here"),
        ("error rate dropped 97%", "rate dropped PCTVAL"),
        (None, "none"),
    ],
)
def test_normalise(spark, raw, expected):
    assert one(spark, T.normalise_text, raw) == expected


def test_exception_rule_needs_its_option(spark):
    said = "Failed with NullPointerException today"
    assert one(spark, T.normalise_text, said) == "failed with nullpointerexception today"
    assert one(spark, lambda c: T.normalise_text(c, True), said) == "failed with EXCEPTION today"


def test_markers_and_incident_words_survive(spark):
    tokens = one(spark, T.tokenise, "host IPADDR failed at TIMEVAL cpu PCTVAL connections NUMVAL the a")
    assert tokens == ["host", "IPADDR", "failed", "TIMEVAL", "cpu", "PCTVAL", "connections", "NUMVAL"]
    assert one(spark, T.tokenise, "service failed with error unauthorized access down")[-1] == "down"
    assert not set(INCIDENT_WORDS) & set(domain_stop_words())


def test_contractions_and_dashes_split(spark):
    assert one(spark, T.words, "cannot x-cannot gonna a--b") == ["can", "not", "x-", "can", "not", "gon", "na", "a", "--", "b"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(T.ngrams(F.col("t"), 3)).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_lemmas_only_reach_words_in_use_and_are_stable(spark):
    vocab = spark.createDataFrame([(w,) for w in "errors error boxes box glass glas gla men man IPADDR".split()], "form string")
    table = preprocess.lemma_table(vocab)
    got = dict(table.collect())
    assert got["errors"] == "error" and got["boxes"] == "box" and got["men"] == "man"
    assert not set(got.values()) & set(got)  # a lemma has no lemma


def test_token_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "signal_id string, preprocessed_text string")
    assert preprocess.token_stats(empty).first().asDict() == {
        "signals": 0, "avg_tokens": 0.0, "min_tokens": 0, "max_tokens": 0, "unique_tokens": 0
    }


def test_missing_text_column(spark):
    with pytest.raises(KeyError):
        preprocess.preprocess_signals(spark.range(1), "nope")
