import random
import zlib

import pytest
from pyspark.sql import functions as F

from opsignal.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark):
    found = queries.op5_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) > 0.97 * len(held)
    assert sum(r["rejected"] for r in held) <= 0.03 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, edge_docs, no_docs):
    model = langid.fit(edge_docs)
    got = langid.predict(edge_docs, model)
    assert set(got.columns) == set(edge_docs.columns) | {"lang_pred", "score", "rejected"}
    rows = got.select("text", "lang_pred", "score", "rejected").collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters)
        if not letters:
            assert r["score"] == 0 and r["rejected"]
    assert langid.predict(no_docs, model).collect() == []
    nothing = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.predict(edge_docs, nothing).collect()} == {"und"}


def test_prediction_does_not_depend_on_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    one = {r["doc_id"]: r["score"] for r in langid.predict(docs.coalesce(1), model).collect()}
    many = {r["doc_id"]: r["score"] for r in langid.predict(docs.repartition(9), model).collect()}
    assert all(abs(one[k] - many[k]) < 1e-9 for k in one)


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        sentences = [" ".join(rng.choice(words) for _ in range(8)) + "." for _ in range(rng.randrange(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] = sentences[k].replace(" ", f" {rng.choice(('vile', 'nasty'))}, ", 1)
        rows.append((i, "\n".join(sentences), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_from_documents_and_finds_the_sentence(spark, toxic_docs):
    model = toxicity.fit(toxic_docs, toxic_docs.filter("doc_id % 5 > 0"))
    rows = toxicity.score(toxic_docs.filter("doc_id % 5 = 0"), model).collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    for r in rows:
        if r["predicted"] and r["toxic"]:
            spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]
            assert all("vile" in r["text"][a:b] or "nasty" in r["text"][a:b] for a, b in spans)
    assert toxicity.score(toxic_docs, model).agg(F.max("score")).first()[0] <= 1


def test_toxicity_edges(spark, toxic_docs, edge_docs, no_docs):
    model = toxicity.fit(toxic_docs, toxic_docs)
    rows = toxicity.score(edge_docs, model).select("text", "score", "predicted", "spans").collect()
    assert len(rows) == edge_docs.count()
    assert all((r["score"], r["predicted"], r["spans"]) == (0, 0, "") for r in rows if not (r["text"] or "").strip())
    assert toxicity.score(no_docs, model).collect() == []
    constant = toxicity.fit(toxic_docs, toxic_docs.filter("toxic = 0"))
    assert constant.weights.any() == False  # noqa: E712
    empty = toxicity.fit(toxic_docs, toxic_docs.filter("toxic IS NULL"))
    assert empty.weights.any() == False  # noqa: E712
    twice = toxicity.fit(toxic_docs.unionByName(toxic_docs), toxic_docs.unionByName(toxic_docs))
    assert (twice.weights == model.weights).all() and twice.bias == model.bias
