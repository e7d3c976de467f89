"""The join on rare shared terms: what it may skip, and how its keys stay small."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsignal.operators import similarity, tfidf

SCHEMA = "signal_id string, preprocessed_text string"


def made(n=150, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):  # a few words stand in nearly every text
        own = rng.choices(words, k=rng.randint(1, 8))
        texts.append(" ".join(own + [w for w in ("error", "host", "failed") if rng.random() < 0.9]))
    return sorted(set(texts))


def plain(texts, threshold):
    counts = [Counter(t.split()) for t in texts]
    df = Counter(w for c in counts for w in c)
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}
    vectors = []
    for c in counts:
        raw = {w: n * idf[w] for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append({w: x / norm for w, x in raw.items()})
    out = {}
    for i, a in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            score = sum(x * vectors[j].get(w, 0.0) for w, x in a.items())
            if score >= threshold:
                out[i, j] = score
    return out


@pytest.fixture(scope="module")
def texts():
    return made()


@pytest.fixture(scope="module")
def vectors(spark, texts):
    df = spark.createDataFrame([(f"S{i:04}", t) for i, t in enumerate(texts)], SCHEMA)
    return similarity.index_vectors(df, 0.25).join(similarity.text_members(df), "key")


@pytest.mark.parametrize("per_key", (5, 40, 10_000))
@pytest.mark.parametrize("threshold", (0.25, 0.6))
def test_equals_all_pairs_however_terms_are_dealt(vectors, texts, threshold, per_key):
    name = {r["key"]: int(r["first_id"][1:]) for r in vectors.select("key", "first_id").collect()}
    found = similarity.similar_texts(vectors.drop("first_id", "copies"), threshold, per_key).collect()
    got = {tuple(sorted((name[r["key_a"]], name[r["key_b"]]))): r["cosine"] for r in found}
    want = plain(texts, threshold)
    assert len(found) == len(got) and set(got) == set(want)
    assert all(abs(got[k] - s) < 1e-9 for k, s in want.items())


def test_no_key_holds_more_than_two_blocks(vectors):
    index = similarity.prefix_index(vectors)
    per_key = 6
    assert index.groupBy("id").count().agg(F.max("count")).first()[0] > 3 * per_key
    dealt = similarity.dealt_postings(index, 0.25, per_key)
    # blocks are dealt by a hash: of about the set size, two in a key
    assert dealt.groupBy("id", "i", "j").count().agg(F.max("count")).first()[0] <= 4 * per_key


def test_long_rests_are_skipped(vectors, texts):
    """Far fewer rows are joined than pairs of texts that share a prefix term."""
    index = similarity.prefix_index(vectors)
    shared = index.groupBy("id").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert similarity.meeting_postings(index, 0.6).count() < shared / 3


def test_threshold_must_be_above_zero(spark):
    df = spark.createDataFrame([("a", "x y")], SCHEMA)
    for threshold in (0.0, -1.0):
        with pytest.raises(ValueError, match="above 0"):
            similarity.similar_pairs(df, threshold)
        with pytest.raises(ValueError, match="above 0"):
            tfidf.text_vectors(df, threshold)
