"""Looking up new texts: lemmas of the corpus, and an index that stays where it lies."""

import random

import pytest
from pyspark.sql import functions as F

from opsignal.operators import preprocess, similarity
from opsignal.session import new_path
from opsignal.streaming import score

WORDS = ["error", "errors", "class", "classes", "women", "woman", "box", "boxes", "IPADDR", "disks", "disk", "batches", "s"]


@pytest.fixture(scope="module")
def lemma(spark):
    forms = spark.createDataFrame([(w,) for w in [*WORDS, *[f"w{i}" for i in range(300)], *[f"w{i}s" for i in range(300)]]], "form string")
    return preprocess.lemma_table(forms)


def texts(spark, n=60):
    rng = random.Random(4)
    pool = [*WORDS, "disk's", "glass", *[f"w{i}s" for i in range(0, 400, 7)]]
    rows = [(f"S{i:03}", " ".join(rng.choices(pool, k=rng.randrange(8)))) for i in range(n)] + [("N", None)]
    return spark.createDataFrame(rows, "signal_id string, normalised_text string")


def test_lemmas_in_an_expression_equal_a_join(spark, lemma):
    df = texts(spark)
    looked_up = preprocess.preprocess_signals(df, lemma=preprocess.lemma_lookup(lemma))
    joined = preprocess.preprocess_signals(df, lemma=lemma)
    got, want = ({r["signal_id"]: (r["tokens"], r["preprocessed_text"]) for r in x.collect()} for x in (looked_up, joined))
    assert got == want
    assert any("error" in (t or []) for t, _ in got.values()) and not any("errors" in (t or []) for t, _ in got.values())
    assert "Exchange" not in looked_up._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch(spark, lemma):
    folder = new_path(spark, "texts")
    texts(spark).write.parquet(folder)
    found = preprocess.lemma_lookup(lemma)
    arriving = spark.readStream.schema("signal_id string, normalised_text string").parquet(folder)
    stream = score.to_table(preprocess.preprocess_signals(arriving, lemma=found), "texts")
    batch = preprocess.preprocess_signals(texts(spark), lemma=lemma).select(*stream.columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))


def test_a_large_lemma_table_stays_a_table(spark, lemma):
    with pytest.raises(ValueError, match="join them"):
        preprocess.lemma_lookup(lemma, 10)
    assert preprocess.lemma_lookup(lemma.limit(0)).parts == 1


@pytest.mark.parametrize("partitions", ("4", "200"))
def test_a_lookup_moves_questions_only(spark, partitions):
    rng = random.Random(1)
    rows = [(f"S{i:04}", " ".join(rng.choices([f"w{j}" for j in range(50)], k=6))) for i in range(200)]
    corpus = spark.createDataFrame(rows, "signal_id string, preprocessed_text string")
    index = similarity.index_corpus(corpus, buckets=8)
    questions = spark.createDataFrame([(i, rows[i][1]) for i in range(5)], "item_id long, preprocessed_text string")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        near = similarity.top_k_similar(questions, index, 3)
        plan = near._jdf.queryExecution().executedPlan().toString().split("\n")
        got = near.collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    scans = [n for n, line in enumerate(plan) if "FileScan" in line]
    assert len(scans) == 4
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    for n in scans:  # up to the join that reads the table there is no exchange
        at = depth[n]
        for m in range(n - 1, -1, -1):
            if depth[m] < at:
                at = depth[m]
                if "Join" in plan[m]:
                    break
                assert "Exchange" not in plan[m], "\n".join(plan)
    assert {(r["item_id"], r["signal_id"]) for r in got if r["rank"] == 1} == {(i, f"S{i:04}") for i in range(5)}


def test_an_index_answers_to_its_depth(spark):
    corpus = spark.createDataFrame([(f"S{i}", "same words") for i in range(9)] + [("T", "other words")], "signal_id string, preprocessed_text string")
    index = similarity.index_corpus(corpus, depth=4, buckets=2)
    ask = spark.createDataFrame([(1, "same words")], "item_id long, preprocessed_text string")
    assert [r["signal_id"] for r in similarity.top_k_similar(ask, index, 4).orderBy("rank").collect()] == ["S0", "S1", "S2", "S3"]
    with pytest.raises(ValueError, match="first 4"):
        similarity.top_k_similar(ask, index, 5)
