"""Sparse vectors multiplied block by block: texts of a corpus, and cells of a category close in time."""

import random

import numpy as np
import pandas as pd
import pytest

from opsignal.operators import correlate, similarity
from test_sparse_join import SCHEMA, made, plain


@pytest.mark.parametrize("at_once", (3, 1 << 20))
def test_products_equal_dense_ones(monkeypatch, at_once):
    monkeypatch.setattr(similarity, "_AT_ONCE", at_once)
    monkeypatch.setattr(similarity, "_COLUMNS", 2)
    rng = np.random.default_rng(1)
    ends = [rng.random((n, 40)) * (rng.random((n, 40)) < np.linspace(0.02, 0.9, 40)) for n in (30, 23)]
    ends[0][4] = 0
    sparse = [[pd.Series(x) for x in zip(*[(np.flatnonzero(r) * 7919, r[r > 0]) for r in m])] for m in ends]
    assert np.allclose(similarity.sparse_products(*sparse), ends[0] @ ends[1].T)
    strange = [pd.Series([np.array([-5])]), pd.Series([np.array([1.0])])]
    assert similarity.sparse_products(sparse[0], strange).tolist() == [[0.0]] * 30


@pytest.mark.parametrize("block_rows", (7, 60, 2048))
def test_texts_meet_in_blocks_and_not_in_postings(spark, monkeypatch, block_rows):
    texts = made()
    df = spark.createDataFrame([(f"S{i:04}", t) for i, t in enumerate(texts)], SCHEMA)
    vectors = similarity.index_vectors(df, 0.25)
    name = {r["key"]: int(r["first_id"][1:]) for r in similarity.text_members(df).collect()}

    def listed(*_):
        raise AssertionError("pairs of postings are listed")

    monkeypatch.setattr(similarity, "meeting_postings", listed)
    rows = similarity.similar_texts(vectors, 0.25, block_rows=block_rows).collect()
    got = {tuple(sorted((name[r["key_a"]], name[r["key_b"]]))): r["cosine"] for r in rows}
    want = plain(texts, 0.25)
    assert len(rows) == len(got) and set(got) == set(want)
    assert all(r["key_a"] < r["key_b"] for r in rows) and all(abs(got[k] - s) < 1e-9 for k, s in want.items())
    nothing = vectors.filter("key = ''")
    assert similarity.similar_texts(nothing, 0.25).count() == 0


@pytest.mark.parametrize("block_rows", (2, 1024))
def test_cells_meet_inside_category_and_touching_buckets(spark, block_rows):
    rng = random.Random(4)
    texts = made(40)
    df = spark.createDataFrame([(f"S{i:04}", t) for i, t in enumerate(texts)], SCHEMA)
    vectors = similarity.index_vectors(df, 0.25)
    key = {r["key"]: int(r["first_id"][1:]) for r in similarity.text_members(df).collect()}
    vid = {key[r["key"]]: r["vid"] for r in vectors.collect()}
    places = sorted({(rng.randrange(len(texts)), rng.choice("xy"), rng.choice((1, 2, 3, 9))) for _ in range(120)})
    rows = [(n, c, b, vid[t], 1, *sorted((rng.randrange(9), rng.randrange(9)))) for n, (t, c, b) in enumerate(places)]
    cells = spark.createDataFrame(rows, "node long, predicted_category string, bucket long, vid long, n long, lo long, hi long")
    found = correlate.lexical_links(cells, vectors, 0.25, block_rows).collect()
    close = plain(texts, 0.25)
    want = {}
    for a, (t, c, b) in enumerate(places):
        for z, (u, d, e) in enumerate(places):
            score = close.get((min(t, u), max(t, u)))
            if score and c == d and (e == b and a < z or e == b + 1 and rows[z][5] <= rows[a][6]):
                want[a, z] = (score, e != b)
    got = {(r["early"], r["late"]): (r["cosine"], r["adjacent"]) for r in found}
    assert len(found) == len(got) and set(got) == set(want)
    assert all(abs(got[k][0] - s) < 1e-9 and got[k][1] == f for k, (s, f) in want.items())


def test_named_pairs_need_no_join_by_pair(spark, monkeypatch):
    monkeypatch.setattr(similarity, "ROWS_AT_ONCE", 5)
    texts = made()
    texts += texts[:9]
    df = spark.createDataFrame([(f"S{i:04}", t) for i, t in enumerate(texts)], SCHEMA)
    vectors, members = similarity.index_vectors(df, 0.25, prefix=False), similarity.text_members(df)
    assert "prefix" not in vectors.columns
    found = similarity.similar_named(vectors, members, 0.25, block_rows=20)
    # Names travel with the vectors: vectors and names, then blocks.
    assert found.filter("signal_a <> signal_b")._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 2
    plain_way = similarity.named_pairs(similarity.similar_texts(vectors, 0.25), vectors, members)
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(map(tuple, plain_way.collect())) and any(r[0] == r[1] for r in rows)


def test_pieces_of_a_block_are_multiplied_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(similarity, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    rows = [(f"s{i:03}", rng.normal(size=4).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "signal_id string, embedding array<double>")
    got = {(r["signal_a"], r["signal_b"]) for r in similarity.dense_similar_pairs(df, 0.3, block_rows=30).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert got == {(rows[x][0], rows[y][0]) for x, y in zip(*np.nonzero(unit @ unit.T >= 0.3)) if x < y}
    monkeypatch.undo()
    assert [similarity.block_count(n, 8192) for n in (0, 5000, 30_000, 100_000)] == [1, 3, 4, 13]
