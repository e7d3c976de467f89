import random
import re
from collections import Counter

import numpy as np
import pytest

from opsignal.llm import recompress

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """Kept texts: every window that stands twice loses its words everywhere."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for (number, text), w in zip(rows, docs):
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((number, len(w), len(gone), None if text is None else kept))
    return sorted(out, key=str)


def result(df, *args):
    return sorted(map(tuple, recompress.dedup_substrings(df, *args).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [[rng.choice("abcdefgh") for _ in range(rng.randrange(4, 30))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(pool)
            words += p[rng.randrange(4) : len(p) - rng.randrange(3)] if rng.random() < 0.6 else [rng.choice(["q", "é", "a"])] * rng.randrange(12)
            if rng.random() < 0.5:
                words.append(str(rng.random()))
        rows.append((i if i % 7 else None, rng.choice((" ", "\n", " \t")).join(words) if i % 11 else None))
    rows += rows[3:6]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for window, rounds in ((5, 1), (8, 2), (8, 6)):
        assert result(df, window, rounds) == brute(rows, window)


def test_equal_passages_get_equal_symbols_inside():
    rng = np.random.default_rng(1)
    passage = rng.integers(1, 50, 200).astype(np.uint64)
    found = []
    for n in (3, 17):
        around = rng.integers(1, 50, n).astype(np.uint64)
        words = np.concatenate((around, passage, around))
        symbols, _, steps = recompress.parse(words, np.zeros(len(words), int), 6)
        left, right = recompress.narrow(steps, np.array([n]), np.array([n + 200]))
        found.append(symbols[left[0] : right[0]].tolist())
    assert found[0] == found[1] and len(found[0]) > 10


def test_one_word_over_and_over(spark):
    rows = [(0, "a " * 40), (1, "x " + "a " * 6), (2, "a " * 5), (3, "a " * 4)]
    assert result(spark.createDataFrame(rows, SCHEMA), 5) == brute(rows, 5)


def test_large_group_of_copies_and_a_common_passage(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, passage + " end") for i in range(300)] + [(1000 + i, f"own{i} {passage} tail{i}") for i in range(300)]
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got == brute(rows, recompress.WINDOW)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    for window in (3, recompress.WINDOW):
        assert result(edge_docs, window) == brute(rows, window)
    assert recompress.dedup_substrings(no_docs).collect() == []
