"""The closest pairs of each stratum and the focus pairs, against listings of all pairs."""

import datetime
import random

import numpy as np
import pytest

from opsignal.operators import correlate
from opsignal.operators.pairstats import compare_backends, focus_pairs

SCHEMA = "signal_id string, incident_group string, category string, preprocessed_text string, embedding array<double>"


def units(score):
    score = round(score, 9)
    return int(np.sign(score) * np.floor(abs(score) * 10_000 + 0.5))


def plain(rows, show):
    pairs = []
    rows = sorted(r for r in rows if r[4] is not None)
    for x, a in enumerate(rows):
        for b in rows[x + 1 :]:
            u, v = np.array(a[4]), np.array(b[4])
            size = np.sqrt((u @ u) * (v @ v))
            same, alike = a[1] == b[1], a[2] == b[2]
            pairs.append((0 if same else 2 if alike else 1, -units(u @ v / size if size else 0.0), a[0], b[0], same, alike))
    pairs.sort()
    half = show // 2
    by = [[p for p in pairs if p[0] == s] for s in range(3)]
    chosen = by[0][:half] + by[1][: show - half]
    chosen += by[2][: show - len(chosen)]
    return sorted((a, b, -u, same, alike) for _, u, a, b, same, alike in chosen)


def shown(df, *args):
    return sorted(
        (r["signal_a"], r["signal_b"], round(r["dense_score"] * 10_000), r["same_incident"], r["same_category"])
        for r in compare_backends(df, *args).collect()
    )


def test_equal_vectors_of_one_incident_are_shown(spark):
    rows = [(f"s{i:02}", f"I{i // 2}", "c" if i < 6 else "d", "text", [1.0, float(i // 2)]) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = shown(df, 8)
    assert got == plain(rows, 8)
    assert sum(r[3] for r in got) == 4 and len(got) == 8


@pytest.mark.parametrize("block_rows", (4, 1024))
@pytest.mark.parametrize("seed", range(2))
def test_strata_equal_a_listing(spark, seed, block_rows):
    rng = random.Random(seed)
    pool = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(9)] + [[0.0] * 4, None]
    rows = [
        (f"s{i:02}", rng.choice(["x", "y", "z", None]), rng.choice(["c", "d", None]), rng.choice(["a b", "b c", ""]), rng.choice(pool))
        for i in range(40)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for show in (3, 8):
        assert shown(df, show, "embedding", "preprocessed_text", block_rows) == plain(rows, show)


def test_short_strata_are_filled_up(spark):
    rows = [(f"s{i}", f"I{i}", "c", "t", [1.0, float(i)]) for i in range(5)]
    got = shown(spark.createDataFrame(rows, SCHEMA), 6)
    assert got == plain(rows, 6) and all(r[4] and not r[3] for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_focus_pairs(spark, seed):
    rng = random.Random(seed)
    most = rng.choice([["F1"] * 8 + ["F2", "F3"], ["F1", "F2", "F3", "G1", None]])
    rows = [(f"s{i:02}", rng.choice(most), "c", f"w{i % 5} common", [1.0, float(i % 4)]) for i in range(25)]
    df = spark.createDataFrame(rows, SCHEMA)
    focus = sorted(r for r in rows if r[1] and r[1].startswith("F"))
    every = [(a[0], b[0], a[1] == b[1]) for x, a in enumerate(focus) for b in focus[x + 1 :]]
    want = [p for p in every if p[2]] + sorted(p for p in every if not p[2])[:6]
    got = focus_pairs(df, ["F"])
    assert sorted((r["signal_a"], r["signal_b"], r["same_incident"]) for r in got.collect()) == sorted(want)
    assert got.columns == ["signal_a", "signal_b", "similarity", "dense_score", "same_incident"]
    assert "dense_score" not in focus_pairs(df.drop("embedding"), ["F"]).columns


def test_a_sweep_below_the_links_is_refused(spark):
    rows = [(f"s{i}", "log", "a", 0.5, 0.0, datetime.datetime(2024, 1, 1, 10), f"word{i} same", "g") for i in range(4)]
    schema = (
        "signal_id string, source_type string, predicted_category string, confidence double, anomaly_score double, "
        "timestamp timestamp, preprocessed_text string, incident_group string"
    )
    df = spark.createDataFrame(rows, schema)
    links = correlate.link_signals(df, 0.3)
    assert correlate.threshold_sweep(links, df, [0.3, 0.5]).count() == 2
    with pytest.raises(ValueError, match="below it"):
        correlate.threshold_sweep(links, df, [0.5, 0.2])


def test_nested_labels_equal_components_of_each_threshold(spark):
    rng = random.Random(5)
    edges = [(a, b, rng.choice([0.3, 0.5, 0.7, 0.9])) for a, b in (rng.sample(range(60), 2) for _ in range(70))]
    cells = spark.createDataFrame([(i, 1 + i % 2) for i in range(64)], "node bigint, n bigint")
    found = spark.createDataFrame(edges, "early bigint, late bigint, cosine double")
    links = correlate.Links(None, None, cells, found, None, 0.3)
    nested = correlate.nested_labels(links, [0.5, 0.95, 0.3, 0.7])
    assert set(nested) == {0.5, 0.95, 0.3, 0.7}
    for t, labels in nested.items():
        root = list(range(64))
        for _ in range(64):
            for a, b, s in edges:
                if s >= t:
                    root[a] = root[b] = min(root[a], root[b])
        linked = {x for a, b, s in edges if s >= t for x in (a, b)}
        want = sorted((i, root[i]) for i in range(64) if i in linked or i % 2)
        assert sorted(map(tuple, labels.collect())) == want
