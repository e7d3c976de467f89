"""Correlation over vectors against plain pairs and a plain union of them."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsignal.operators import correlate, similarity

SCHEMA = (
    "signal_id string, source_type string, predicted_category string, confidence double, anomaly_score double, "
    "timestamp timestamp, embedding array<float>, incident_group string"
)
START = datetime.datetime(2024, 1, 1, 10)
HALF_HOUR = datetime.timedelta(minutes=30)


def made(n=120, seed=1):
    rng = random.Random(seed)
    pool = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(25)] + [[0.0] * 6, None, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]]
    rows = []
    for i in range(n):
        at = START + datetime.timedelta(seconds=rng.choice([rng.randrange(9000), 1800 * rng.randrange(5)]))
        rows.append((f"s{i:03}", rng.choice(["alert", "log"]), rng.choice(["a", "a", "b", None]), 0.7, 0.1, at, rng.choice(pool), "g"))
    return rows


def plain_pairs(rows, threshold):
    out = {}
    for x in range(len(rows)):
        for y in range(x + 1, len(rows)):
            a, b = rows[x], rows[y]
            if a[2] is None or a[2] != b[2] or abs(a[5] - b[5]) > HALF_HOUR or a[6] is None or b[6] is None:
                continue
            u, v = (np.array(r[6], np.float32).astype(float) for r in (a, b))
            score = u @ v / np.sqrt((u @ u) * (v @ v)) if (u @ u) * (v @ v) > 0 else 0.0
            if score >= threshold:
                out[a[0], b[0]] = score
    return out


def components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for x in list(root):
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("block_rows", (3, 1024))
def test_pairs_and_groups_equal_plain_ones(spark, monkeypatch, block_rows):
    multiply = correlate.dense_links
    monkeypatch.setattr(correlate, "dense_links", lambda c, v, t: multiply(c, v, t, block_rows))
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain_pairs(rows, 0.4)
    found = correlate.correlate_signals(df, 0.4)
    members = similarity.members_of(df, similarity.vector_key())
    pairs = correlate.gated_pairs(found.links, members).collect()
    assert sum(int(r["pairs"]) for r in pairs) == len(want)
    assert all(r["similarity"] >= 0.4 for r in pairs)
    grouped = found.members().groupBy("group_id").agg(F.sort_array(F.collect_list("signal_id")).alias("ids")).collect()
    assert sorted(r["ids"] for r in grouped) == components(want)
    mean = {tuple(r["ids"]): r["group_id"] for r in grouped}
    for r in found.groups.collect():
        ids = next(set(k) for k, g in mean.items() if g == r["group_id"])
        scores = [round(s, 4) for (a, b), s in want.items() if a in ids]
        assert r["signal_count"] == len(ids) and r["avg_similarity"] == pytest.approx(sum(scores) / len(scores), abs=2e-4)


def test_the_backend_is_chosen_by_what_is_there(spark):
    rows = [(f"s{i}", "log", "a", 0.5, 0.0, START, [1.0, float(i % 2)], "g") for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("preprocessed_text", F.concat(F.lit("same words "), "signal_id"))
    assert correlate.link_signals(df, 0.9).edges.count() == 0 and correlate.link_signals(df, 0.5).edges.count() == 1
    assert correlate.link_signals(df, 0.1, backend="lexical").edges.count() == 6
    assert correlate.link_signals(df.drop("embedding"), 0.1, backend="dense").edges.count() == 6


def test_no_signals(spark):
    assert correlate.correlate_signals(spark.createDataFrame([], SCHEMA), 0.4).groups.collect() == []
