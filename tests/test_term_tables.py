"""Term tables: counted where a text is, and vocabularies whose document counts follow the choice of terms."""

import re
from collections import Counter

import pytest

from opsignal.config import Config
from opsignal.operators import tfidf

ROWS = [("a", "x1 y1 x1 z1"), ("b", "x1 y1"), ("b", "y1 q1"), ("c", ""), ("d", "x1 y1"), (None, "z1 z1"), (None, None)]
SCHEMA = "signal_id string, preprocessed_text string"


@pytest.mark.parametrize("at_once", (1, 1 << 18))
def test_postings_of_distinct_texts(spark, monkeypatch, at_once):
    monkeypatch.setattr(tfidf, "TERMS_AT_ONCE", at_once)
    found = tfidf.text_postings(spark.createDataFrame(ROWS, SCHEMA).coalesce(1))
    assert "Exchange hashpartitioning(key" not in found._jdf.queryExecution().toString()
    copies = Counter(t for _, t in ROWS if t)
    want = sorted((n, term, tf) for t, n in copies.items() for term, tf in Counter(t.split()).items())
    assert sorted((r["copies"], r["term"], r["tf"]) for r in found.collect()) == want


def test_documents_are_counted_for_chosen_terms_only(spark):
    cfg = Config(max_features=3)
    model = tfidf.tfidf_fit(spark.createDataFrame(ROWS, SCHEMA).repartition(3), cfg=cfg)
    total, holders = Counter(), {}
    for key, text in ROWS:
        words = (text or "").split()
        for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            total[term] += 1
            holders.setdefault(term, set()).add(key)
    chosen = sorted(sorted(total), key=lambda t: -total[t])[:3]
    got = {r["term"]: r["idf"] for r in model.vocab.collect()}
    import math

    want = {t: math.log((1 + len(ROWS)) / (1 + len(holders[t]))) + 1 for t in chosen}
    assert got == pytest.approx(want)
    plan = model.vocab._jdf.queryExecution().executedPlan().toString()
    # keys travel with whole texts only: no exchange by key and term
    assert not re.search(r"hashpartitioning\(signal_id#\d+, term", plan)
