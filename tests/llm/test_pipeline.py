"""The stages one after the other, each held against a plain version on what its predecessor kept."""

import pytest

import corpus_pipeline
from opsignal.llm import common, decontam, langid, queries
from test_jaccard import brute as classes_of
from test_linededup import brute as lines_kept
from test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_on_the_documents_table(spark):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_copies", "test_items", "sequences"]

    found = {r["doc_id"]: r["rejected"] for r in langid.predict(docs, queries.language_model(spark, SF)).collect()}
    a = common.materialise(stages["language"](spark, docs, SF), "a")
    assert a.columns == columns
    assert sorted(r[0] for r in a.select("doc_id").collect()) == sorted(d for d, gone in found.items() if not gone)

    b = common.materialise(stages["lines"](spark, a, SF), "b")
    assert b.columns == columns
    rows = [tuple(r) for r in a.select("doc_id", "text").collect()]
    assert {r["doc_id"]: r["text"] for r in b.collect()} == lines_kept(rows, 50)

    c = common.materialise(stages["near_copies"](spark, b, SF), "c")
    assert c.columns == columns
    classes = classes_of([tuple(r) for r in b.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in c.collect()) == sorted(d for d, _, first in classes if d == first)

    d = common.materialise(stages["test_items"](spark, c, SF), "d")
    assert d.columns == columns
    hit = {r["doc_id"] for r in decontam.contaminated(c, common.table(spark, SF, "benchmark")).collect()}
    assert {r["doc_id"] for r in d.collect()} == {r["doc_id"] for r in c.collect()} - hit

    docs_left = [tuple(r) for r in d.select("doc_id", "text").collect()]
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r["length"] for r in pieces) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0)
    assert {r["doc_id"] for r in pieces} == {i for i, _ in docs_left}
    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    check([{**r.asDict(), "text_row": r["doc_id"]} for r in pieces], docs_left, tokenizer)


def test_stages_on_odd_rows_and_none(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs_after = common.materialise(stage(spark, docs, SF), name)
            assert docs_after.columns == docs.columns
            docs = docs_after
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_columns_of_the_caller_come_through(spark):
    from pyspark.sql import functions as F

    own = {"score": 42, "N_Lines": 7, "Rejected": 1, "n_deleted": 3, "lang_pred": 5}
    docs = common.table(spark, SF, "documents").limit(60).select("*", *[F.lit(v).alias(c) for c, v in own.items()])
    docs = common.materialise(docs, "own")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("language", "lines"):
        docs = common.materialise(stages[name](spark, docs, SF), name)
        rows = docs.select(*own).distinct().collect()
        assert [r.asDict() for r in rows] == [own]


def test_empty_documents_stay_empty(spark):
    docs = common.table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, SF), name)
        assert docs.count() == 0
