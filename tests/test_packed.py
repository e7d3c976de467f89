"""Texts and cells packed into blocks: pairs, counts and links against plain versions, and what goes to disk."""

import datetime
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsignal.operators import correlate, evaluate, packed, pairstats, similarity
from opsignal.session import discard, exists, materialise

SCHEMA = "signal_id string, preprocessed_text string, incident_group string"


def made(n=70, seed=7):
    """Signals with copies, texts without terms, null texts and null incidents."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 12))) for _ in range(n)]
    texts += rng.sample(texts, 20) + ["", "a", None, "a"]
    return [(f"S{i:04}", t, rng.choice(["x", "y", "z", None])) for i, t in enumerate(texts)]


def scores(rows):
    """Cosine of every pair of signals that have terms, by their numbers."""
    counts = [Counter(w for w in (t or "").split() if len(w) > 1) for _, t, _ in rows]
    df = Counter(w for c in counts for w in c)
    vectors = []
    for c in counts:
        raw = {w: n * (math.log((1 + len(rows)) / (1 + df[w])) + 1) for w, n in c.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({w: v / length for w, v in raw.items()})
    return {
        (a, b): sum(v * vectors[b].get(w, 0.0) for w, v in vectors[a].items())
        for a in range(len(rows)) for b in range(a + 1, len(rows)) if vectors[a] and vectors[b]
    }


@pytest.mark.parametrize("block_rows,terms", [(2048, 1 << 20), (9, 1 << 20), (2048, 30)])
def test_similar_blocks_equal_plain_scores(spark, block_rows, terms):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    blocks = packed.text_blocks(df, similarity.text_members(df), block_rows=block_rows, terms=terms)
    found = similarity.packed_pairs(blocks, similarity.members_with_terms(df), 0.25)
    first = {}
    for i, (name, t, _) in enumerate(rows):
        first.setdefault(t, name)
    want = Counter()
    for (a, b), s in scores(rows).items():
        if s >= 0.25:
            want[(*sorted((first[rows[a][1]], first[rows[b][1]])), round(s, 4))] += 1
    got = {(r["signal_a"], r["signal_b"], round(r["similarity"], 4)): int(r["n_pairs"]) for r in found.collect()}
    assert got == want and any(a == b for a, b, _ in got)


def test_pairs_of_blocks_shuffle_blocks_once(spark):
    df = spark.createDataFrame(made(), SCHEMA).repartition(3)
    blocks = packed.text_blocks(df, similarity.text_members(df), block_rows=9)
    found = packed.similar_blocks(blocks, 0.25)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning" not in plan
    # The other side reads the same shuffle.
    assert plan.split("Initial Plan")[0].count("ReusedExchange") == 1
    # Each pair of blocks once.
    met = packed.pairs_of_blocks(blocks).select(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).collect()
    n = blocks.count()
    assert n > 8 and len(set(met)) == len(met) == n * (n + 1) // 2


def test_the_index_has_each_text_once(spark):
    rows = [(f"S{i}", t, None) for i, t in enumerate(["one two two", "one two two", "two three", "", "one two two"])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4, "signal_id")
    index = similarity.index_corpus(df, depth=2, buckets=2)
    assert sorted(r["tf"] for r in index.weights.collect()) == [1, 1, 1, 2]
    assert sorted((r["signal_id"], r["i"]) for r in index.signals.collect()) == [("S0", 1), ("S1", 2), ("S2", 1)]
    assert set(index.weights.columns) == {"id", "vid", "tf"} and index.idf.count() == 3


@pytest.mark.parametrize("block_rows", (9, 2048))
def test_counted_pairs_equal_listed_ones(spark, block_rows):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    texts = evaluate.truth_of_texts(evaluate.truth_counts(df))
    levels = (0.25, 0.5, 0.75)
    counted = materialise(packed.pair_totals(packed.text_blocks(df, texts, block_rows=block_rows), 0.25, levels), "counts")
    all_pairs = scores(rows)
    alike = {(a, b): rows[a][2] == rows[b][2] for a, b in all_pairs}
    high = {p for p, s in all_pairs.items() if s >= 0.25}
    found = evaluate.evaluate_counted_pairs(counted, df).first()
    assert (found["total_pairs"], found["true_positives"]) == (len(high), sum(alike[p] for p in high))
    mean = sum(round(all_pairs[p], 4) for p in high if alike[p]) / sum(alike[p] for p in high)
    assert found["avg_score_same_incident"] == pytest.approx(mean, abs=1e-4)
    vectors = similarity.index_vectors(df, 0.25)
    pairs = similarity.similar_texts(vectors, 0.25)
    assert found == evaluate.evaluate_pairs(pairs, vectors, evaluate.truth_counts(df)).first()
    by_type = {r["pair_type"]: r for r in pairstats.counted_distribution(df, counted, levels).collect()}
    plain = {r["pair_type"]: r for r in pairstats.score_distribution(df, pairs, vectors, levels).collect()}
    assert by_type == plain
    assert by_type["Same Incident"]["above_50"] == sum(s >= 0.5 and alike[p] for p, s in all_pairs.items())


def test_no_texts_no_pairs(spark):
    df = spark.createDataFrame([("a", "", None), ("b", None, "x")], SCHEMA)
    assert similarity.similar_pairs(df, 0.25).collect() == []
    counted = packed.pair_totals(packed.text_blocks(df, evaluate.truth_of_texts(evaluate.truth_counts(df))), 0.25)
    assert evaluate.evaluate_counted_pairs(counted, df).first()["total_pairs"] == 0
    rows = pairstats.counted_distribution(df, counted, (0.25,)).collect()
    assert sorted((r["pairs"], r["mean_score"]) for r in rows) == [(0, 0.0), (1, 0.0)]
    with pytest.raises(ValueError, match="above 0"):
        similarity.similar_pairs(df, 0.0)


@pytest.mark.parametrize("block_rows", (1, 3, 1024))
def test_packed_cells_meet_like_dealt_ones(spark, block_rows):
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (name, t, rng.choice(["a", "b", None]), start + datetime.timedelta(minutes=rng.choice((0, 5, 20, 31, 55, 62, 300, 331, 900))), "log")
        for name, t, _ in made(60)
    ]
    df = spark.createDataFrame(rows, "signal_id string, preprocessed_text string, predicted_category string, timestamp timestamp, source_type string")
    links = correlate.link_signals(df, 0.25)
    vectors = similarity.index_vectors(df, 0.25)
    cells = links.cells.join(vectors.select("key", "vid"), "key")
    assert cells.count() == links.cells.count()
    texts = df.select(F.md5("preprocessed_text").alias("key"), F.col("preprocessed_text").alias("cell_text")).distinct()
    packs = correlate.pack_cells(links.cells.join(texts, "key"), block_rows)
    found = correlate.packed_links(packed.with_idf(packs, df), 0.25)
    columns = ["early", "late", "n_e", "n_l", "lo_e", "hi_e", "lo_l", "hi_l", "adjacent", F.round("cosine", 9).alias("cosine")]
    want = sorted(map(tuple, correlate.lexical_links(cells, vectors, 0.25).select(*columns).collect()))
    assert sorted(map(tuple, found.select(*columns).collect())) == want and {r[8] for r in want} == {True, False}


def test_neighbouring_buckets_share_a_block(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(f"S{i:03}", f"word{i} same", "a", start + datetime.timedelta(minutes=30 * i), "log") for i in range(40)]
    df = spark.createDataFrame(rows, "signal_id string, preprocessed_text string, predicted_category string, timestamp timestamp, source_type string")
    texts = df.select(F.md5("preprocessed_text").alias("key"), F.col("preprocessed_text").alias("cell_text"))
    packs = correlate.pack_cells(correlate.link_signals(df, 0.25).cells.join(texts, "key"), 10)
    # 40 texts in four blocks; the ends of two blocks meet in one more.
    assert sum(len(r["sizes"]) // 4 for r in packs.collect()) == 40 + 3 * 2


def test_written_tables_keep_no_shuffles_and_can_go(spark):
    df = materialise(spark.range(50).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert df.count() == 7 and exists(spark, df.written_to)
    discard(df)
    assert not exists(spark, df.written_to)
