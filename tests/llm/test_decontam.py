import re

import numpy as np
import pytest

from opsignal.llm import common, decontam


def words(text):
    return re.sub(r"[^0-9a-z\u0080-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).split()


def align(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[-1] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment_equals_plain_recursion():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        assert decontam.smith_waterman(a, b) == align(list(a), list(b))


def test_finds_all_pairs_with_a_seed_in_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    items = common.table(spark, "/root/testdata/sf0.001", "benchmark")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.contaminated(docs, items).collect()}
    want = {}
    item_words = {r["item_id"]: words(r["text"]) for r in items.collect()}
    for r in docs.collect():
        own = words(r["text"])
        grams = {tuple(own[i : i + 4]) for i in range(len(own))}
        for i, w in item_words.items():
            shared = sum(tuple(w[k : k + 4]) in grams for k in range(len(w) - 3))
            if shared > 0.3 * len(w):
                score = align(w, own) / (2 * len(w))
                if score >= decontam.SCORE:
                    want[r["doc_id"], i] = score
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("change", ["none", "case", "every8th", "drop", "insert"])
def test_edited_copies(spark, change):
    item = [f"w{i}" for i in range(40)]
    copy = {
        "none": item,
        "case": [w.upper() + "," for w in item],
        "every8th": [f"x{i}" if i % 8 == 7 else w for i, w in enumerate(item)],
        "drop": [w for i, w in enumerate(item) if i % 9],
        "insert": [x for i, w in enumerate(item) for x in ([w, "new"] if i % 7 == 0 else [w])],
    }[change]
    filler = " ".join(f"f{i}" for i in range(300))
    docs = spark.createDataFrame([(1, filler + " " + " ".join(copy) + " " + filler), (2, filler), (3, " ".join(item[:12]) + filler)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (9, None), (None, "a b c d e f")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()] == [(1, 7)]
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(docs, items).collect()) == [2, 3]


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "same words here again and again")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.contaminated(edge_docs, items).collect()) == [4, 5]
    assert decontam.contaminated(no_docs, items).collect() == []
    assert decontam.contaminated(edge_docs, items.limit(0)).collect() == []
    assert decontam.drop_contaminated(edge_docs, items).columns == edge_docs.columns
    assert decontam.drop_contaminated(edge_docs, items.limit(0)).count() == edge_docs.count()
