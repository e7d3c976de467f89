import random

import pytest

from opsignal.llm import jaccard
from opsignal.llm import common


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(df):
    return sorted((tuple(r) for r in jaccard.classes(df).collect()), key=str)


def test_documents_table(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    assert run(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", range(2))
def test_chains_and_shared_passages(spark, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(14))
    rows, text = [], [f"w{i}" for i in range(60)]
    for i in range(60):  # a chain of edits, a hot passage in short and long texts, copies
        text = list(text)
        text[rng.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(text)))
        rows.append((100 + i, passage + " " + " ".join(rng.choice("abc") for _ in range(rng.randrange(4)))))
        rows.append((200 + i, " ".join(f"q{rng.randrange(9)}" for _ in range(rng.randrange(12)))))
        rows.append((300 + i, rows[rng.randrange(len(rows))][1].upper()))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(df) == brute(rows)


def test_edges(spark, edge_docs, no_docs):
    assert run(edge_docs) == brute([tuple(r) for r in edge_docs.select("doc_id", "text").collect()])
    assert run(no_docs) == []


def test_one_stays(spark, edge_docs, no_docs):
    kept = jaccard.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "1", "2", "3", "4", "6", "7", "None", "None"]
    assert jaccard.keep_one(no_docs).collect() == []


def test_common_columns_come_last(spark):
    rows = [(i, "a b c d e f g") for i in range(5)] + [(9, "h i j k l m n o")]
    common_ = jaccard.common_columns(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 5)
    assert len(common_) == 3


def test_blocks_of_columns(spark, monkeypatch):
    """Cells travel in a few bytes; pairs are counted over all blocks, columns of many rows come out as they are."""
    monkeypatch.setattr(jaccard, "PACKED", 64)
    rng = random.Random(3)
    texts = {i: " ".join(rng.choices([f"w{k}" for k in range(40)], k=200)) for i in range(60)}
    texts |= {100 + i: texts[i].replace("w7 ", "x ", 1) for i in range(20)}
    texts |= {200 + i: f"one two three four five six" for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    inc = jaccard.incidence(df, 5, 80, jaccard.common_columns(df, 5)).selectExpr("doc_id AS row", "n", "prefix")
    prefixes = {r["row"]: (r["n"], set(r["prefix"])) for r in inc.collect()}
    cells = sum(len(p) for _, p in prefixes.values())
    packs = jaccard.packed_cells(inc.coalesce(1), 2).collect()
    assert sum(p["cells"] for p in packs) == cells
    assert sum(len(p[c]) for p in packs for c in ("columns", "rows", "sizes", "places")) < 10 * cells

    where = {}
    for row, (_, grams) in prefixes.items():
        for g in grams:
            where.setdefault(g, []).append(row)
    shared = {}
    for rows in where.values():
        if len(rows) <= jaccard.FEW:
            for a in rows:
                for b in rows:
                    (n, _), (n2, _) = prefixes[a], prefixes[b]
                    if a < b and 100 * min(n, n2) >= 80 * max(n, n2):
                        shared[a, b, n, n2] = shared.get((a, b, n, n2), 0) + 1
    few, large = jaccard.met_columns(inc, 80, cells)
    assert {tuple(r)[:4]: r["shared"] for r in few.select("row", "row2", "n", "n2", "shared").collect()} == shared
    many = [len(rows) for rows in where.values() if len(rows) > jaccard.FEW]
    assert many and large.count() == sum(many)
    assert run(df) == brute(list(texts.items()))
