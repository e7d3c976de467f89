"""Similarity, windows and groups against brute force on small frames."""

import datetime as dt
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsignal.operators import components, correlate, evaluate, similarity, tfidf, timewindow

DAY = dt.datetime(2024, 1, 1)
WINDOW = dt.timedelta(minutes=30)


def sample(seed, n=120):
    """Few texts (many copies), bursts, edge gaps, an empty text, a missing category."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(14)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(2, 6))) for _ in range(18)] + [""]
    rows, t = [], DAY
    for i in range(n):
        t += rnd.choice([dt.timedelta(seconds=rnd.randint(0, 900)), WINDOW, WINDOW + dt.timedelta(microseconds=1), dt.timedelta(0)])
        rows.append((
            f"S{i:04d}", rnd.choice(["alert", "log", "ticket"]), rnd.choice(["A", "B", None]),
            rnd.choice(texts[:3] if i % 3 else texts), t, f"I{i // 3}", round(rnd.random(), 2), round(rnd.random(), 4),
        ))
    rnd.shuffle(rows)
    return rows


SCHEMA = """signal_id string, source_type string, predicted_category string, preprocessed_text string,
 timestamp timestamp, incident_group string, confidence double, anomaly_score double"""


def vectors_of(texts):
    tokens = [Counter(w for w in t.split() if len(w) > 1) for t in texts]
    n, df = len(texts), Counter(w for t in tokens for w in t)
    out = []
    for t in tokens:
        raw = {w: k * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in t.items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        out.append({w: v / norm for w, v in raw.items()})
    return out


def cosine(a, b):
    return sum(v * b.get(w, 0.0) for w, v in a.items())


def brute_edges(rows, threshold):
    vec = vectors_of([r[3] for r in rows])
    for (i, a), (j, b) in itertools.combinations(enumerate(rows), 2):
        if a[2] is not None and a[2] == b[2] and abs(a[4] - b[4]) <= WINDOW and cosine(vec[i], vec[j]) >= threshold:
            yield a[0], b[0], cosine(vec[i], vec[j])


def brute_groups(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, *_ in edges:
        parent[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("seed, threshold", [(1, 0.25), (2, 0.5)])
def test_correlation_equals_brute_force(spark, seed, threshold):
    rows = sample(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = correlate.correlate_signals(df, threshold)
    edges = list(brute_edges(rows, threshold))
    want = brute_groups([r[0] for r in rows], edges)
    members = found.members().select("group_id", "signal_id", "incident_group").collect()
    got = {}
    for m in members:
        got.setdefault(m["group_id"], set()).add(m["signal_id"])
    assert {frozenset(g) for g in got.values()} == want
    assert found.links.edges.count() > 0
    about = {r[0]: r for r in rows}
    for g in found.groups.collect():
        ids = got[g["group_id"]]
        scores = [round(s, 4) for a, b, s in edges if a in ids]
        assert g["signal_count"] == len(ids)
        assert abs(g["avg_similarity"] - sum(scores) / len(scores)) < 1e-4
        times = [about[i][4] for i in ids]
        assert abs(g["time_span_minutes"] - (max(times) - min(times)).total_seconds() / 60) < 0.01
        assert g["source_types"] == sorted({about[i][1] for i in ids})
        assert 0 <= g["confidence_score"] <= 1
    order = [(-g["confidence_score"], -g["signal_count"]) for g in found.groups.orderBy("rank").collect()]
    assert order == sorted(order)
    # Combinatorial evaluation equals listed pairs.
    result = evaluate.evaluate_groups(found.members(), df).first()
    pairs = [p for g in want for p in itertools.combinations(g, 2)]
    hit = sum(about[a][5] == about[b][5] for a, b in pairs)
    true = sum(a[5] == b[5] for a, b in itertools.combinations(rows, 2))
    assert result["precision"] == pytest.approx(hit / len(pairs), abs=1e-4)
    assert result["recall"] == pytest.approx(hit / true, abs=1e-4)


@pytest.mark.parametrize("threshold", [0.1, 0.4, 0.8])
def test_prefix_join_loses_nothing(spark, threshold):
    rnd = random.Random(7)
    texts = sorted({" ".join(rnd.choices([f"w{i}" for i in range(40)], k=rnd.randint(1, 9))) for _ in range(80)})
    texts += texts[:10]
    df = spark.createDataFrame([(f"S{i:03d}", t) for i, t in enumerate(texts)], "signal_id string, preprocessed_text string")
    got = {
        (r["signal_a"], r["signal_b"]): (r["similarity"], int(r["n_pairs"]))
        for r in similarity.similar_pairs(df, threshold).collect()
    }
    vec, first = vectors_of(texts), {}
    for i, t in enumerate(texts):
        first.setdefault(t, f"S{i:03d}")
    want = Counter()
    score = {}
    for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2):
        c = cosine(vec[i], vec[j])
        if c >= threshold:
            pair = tuple(sorted((first[a], first[b])))
            want[pair] += 1
            score[pair] = c
    assert {k: n for k, (_, n) in got.items()} == dict(want)
    assert all(abs(s - score[k]) < 1e-4 for k, (s, _) in got.items())


def test_identical_and_unrelated_texts(spark):
    rows = [("a", "disk full error"), ("b", "disk full error"), ("c", "login refused"), ("d", "")]
    df = spark.createDataFrame(rows, "signal_id string, preprocessed_text string")
    got = [(r["signal_a"], r["signal_b"], r["similarity"], int(r["n_pairs"])) for r in similarity.similar_pairs(df, 0.4).collect()]
    assert got == [("a", "a", 1.0, 1)]


@pytest.mark.parametrize("block_rows", [1000, 7])
def test_dense_blocks_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 8))
    m[50:] = m[:10]
    df = spark.createDataFrame([(f"S{i:02d}", [float(x) for x in v]) for i, v in enumerate(m)], "signal_id string, embedding array<double>")
    got = {(r["signal_a"], r["signal_b"]): int(r["n_pairs"]) for r in
           similarity.dense_similar_pairs(df, 0.3, block_rows=block_rows).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = Counter()
    for i, j in itertools.combinations(range(60), 2):
        if u[i] @ u[j] >= 0.3:
            want[tuple(sorted((f"S{i % 50:02d}", f"S{j % 50:02d}")))] += 1
    assert got == dict(want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_window_counts_equal_brute_force(spark, seed):
    rows = sample(seed, 200)
    got = {r["source_type"]: int(r["pairs"]) for r in
           timewindow.window_pair_counts(spark.createDataFrame(rows, SCHEMA), ["source_type"]).collect()}
    want = Counter(a[1] for a, b in itertools.combinations(rows, 2) if a[1] == b[1] and abs(a[4] - b[4]) <= WINDOW)
    assert got == dict(want)


def test_bucket_pairs_cross_the_border(spark):
    minutes = [25, 40, 85]  # 15 minutes apart across the border of half an hour, then 45
    rows = [(f"S{i}", "log", "A", f"text {i}", DAY + dt.timedelta(minutes=m), "I", 0.5, 0.1) for i, m in enumerate(minutes)]
    found = timewindow.bucket_pair_counts(spark.createDataFrame(rows, SCHEMA), ["predicted_category"]).filter("pairs > 0")
    assert [(r["predicted_category"], int(r["pairs"])) for r in found.collect()] == [("A", 1)]


def test_window_edge_and_chain(spark):
    at = [DAY, DAY + WINDOW, DAY + 2 * WINDOW + dt.timedelta(microseconds=1)]
    rows = [(f"S{i}", "log", "A", "disk full", t, "I", 0.5, 0.1) for i, t in enumerate(at)]
    groups = correlate.correlate_signals(spark.createDataFrame(rows, SCHEMA)).groups.collect()
    assert [(g["signal_count"], g["time_span_minutes"]) for g in groups] == [(2, 30.0)]
    at[2] -= dt.timedelta(microseconds=1)
    rows = [(f"S{i}", "log", "A", "disk full", t, "I", 0.5, 0.1) for i, t in enumerate(at)]
    groups = correlate.correlate_signals(spark.createDataFrame(rows, SCHEMA)).groups.collect()
    assert [(g["signal_count"], g["time_span_minutes"], g["group_id"]) for g in groups] == [(3, 60.0, "CORR-001")]


def test_no_links_give_zeros(spark):
    rows = [("S1", "log", "A", "disk full", DAY, "I", 0.5, 0.1), ("S2", "log", "B", "disk full", DAY, "I", 0.5, 0.1)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = correlate.correlate_signals(df)
    assert found.groups.count() == 0
    result = evaluate.evaluate_groups(found.members(), df).first()
    assert (result["total_groups"], result["precision"], result["recall"], result["f1"]) == (0, 0.0, 0.0, 0.0)


def test_components_do_not_depend_on_edge_order(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (200, 202)]
    for _ in range(2):
        rnd.shuffle(edges)
        mixed = [e if rnd.random() < 0.5 else e[::-1] for e in edges]
        df = spark.createDataFrame(mixed, "src bigint, dst bigint")
        got = dict(components.connected_components(df).collect())
        assert {n: r for n, r in got.items() if n <= 40} == {n: 0 for n in range(41)}
        assert {r for n, r in got.items() if 100 <= n < 200} == {100} and got[202] == 200


def test_top_k_against_brute_force(spark):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choices([f"w{i}" for i in range(12)], k=5)) for _ in range(50)]
    corpus = spark.createDataFrame([(f"S{i:02d}", t) for i, t in enumerate(texts)], "signal_id string, preprocessed_text string")
    asked = spark.createDataFrame([(1, texts[3])], "item_id bigint, preprocessed_text string")
    got = similarity.top_k_similar(asked, similarity.index_corpus(corpus), 5).orderBy("rank").collect()
    vec = vectors_of(texts)
    want = sorted(((-round(cosine(vec[3], v), 4), f"S{i:02d}") for i, v in enumerate(vec)))[:5]
    assert [(-r["similarity"], r["signal_id"]) for r in got] == want


def test_tfidf_needs_a_vocabulary(spark):
    df = spark.createDataFrame([("a", "disk full"), ("b", "disk")], "signal_id string, preprocessed_text string")
    with pytest.raises(ValueError):
        tfidf.tfidf_transform(df, None)
    other = spark.createDataFrame([("z", "nothing known")], "signal_id string, preprocessed_text string")
    assert tfidf.tfidf_transform(other, tfidf.tfidf_fit(df)).count() == 0
