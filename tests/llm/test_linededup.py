import random

import pytest

from opsignal.llm import linededup


def brute(rows, least):
    """Kept texts: a line goes if a run around it of enough words stands at an earlier place."""
    docs = []
    for i, t in sorted(rows, key=lambda r: r[0]):
        lines = [tuple(x.split()) for x in t.split("\n")]
        docs.append((i, t, [x for x in lines if x]))
    places = [(k, p) for k, (_, _, ls) in enumerate(docs) for p in range(len(ls))]
    gone = [set() for _ in docs]
    for n, (k, p) in enumerate(places):
        for j, q in places[:n]:
            a, b, size, words = docs[k][2], docs[j][2], 0, 0
            while p + size < len(a) and q + size < len(b) and a[p + size] == b[q + size]:
                words += len(a[p + size])
                size += 1
            if words >= least:
                gone[k].update(range(p, p + size))
    out = {}
    for k, (i, t, _) in enumerate(docs):
        kept, n, drop = [], -1, False
        for line in t.split("\n"):
            if line.split():
                n += 1
                drop = n in gone[k]
            if not drop:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice((1, 2, 3, 12)))) for _ in range(8)]
    runs = [[rng.choice(pool) for _ in range(rng.randrange(3, 9))] for _ in range(3)]
    rows = []
    for i in range(25):
        lines = []
        for _ in range(rng.randrange(4)):
            lines += rng.choice(runs) if rng.random() < 0.6 else [f"u{i}{rng.random()}", rng.choice(("", "  ", "z"))]
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df, 8).collect()}
    assert got == brute(rows, 8)


def test_long_line_goes_from_later_documents_only(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own {i}\n{passage}\nend {i}") for i in range(30)]
    got = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[i] == (f"own {i}\nend {i}", 1) for i in range(1, 30))


def test_edges(spark, edge_docs, no_docs):
    got = linededup.dedup_lines(edge_docs, 5)
    assert [c for c in got.columns if c not in ("n_lines", "n_deleted")] == edge_docs.columns
    rows = sorted(got.select("doc_id", "text").collect(), key=str)
    want = [(r["doc_id"], "" if r["doc_id"] == 5 else r["text"]) for r in edge_docs.collect()]
    assert sorted(((r[0], r[1]) for r in rows), key=str) == sorted(want, key=str)
    assert linededup.dedup_lines(no_docs).collect() == []
