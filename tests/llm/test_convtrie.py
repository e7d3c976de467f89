import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from opsignal.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes by walking a plain tree of all prefixes; ``(conv_id, turn)`` must be unique."""
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append(((turn is not None, turn or 0), role or "", text or ""))
    conv = {c: [(r, x) for _, r, x in sorted(v)] for c, v in conv.items()}
    built = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(conv.get(c - c % 20, [])[:h] + v[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in children[s]) if children[s] else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        saved[s] = (len(members[s]) - 1) * words + sum(saved[k] for k in children[s])
    out = []
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(s))))
        up = min(members[s[:-1]]) if s else None
        out.append((min(m), len(s), up, len(m), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, *args):
    return sorted(map(tuple, convtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), *args).collect()), key=str)


@pytest.mark.parametrize("size", (1, 2, 4))
def test_equals_a_plain_tree(spark, size, monkeypatch):
    monkeypatch.setattr(convtrie, "STRETCH", 2)
    rng = random.Random(size)
    rows = {}
    for _ in range(400):
        c, turn = rng.randrange(60), rng.choice([None, *range(12)])
        rows[c, turn] = (c, turn, rng.choice("us"), rng.choice(["a", "b b", " c\td e", None]))
    for c in range(100, 160):  # a large group of copies
        rows.update({(c, t): (c, t, "u", "same") for t in range(9)})
    for c in range(1000, 1030):  # short ones: some lose all turns
        rows.update({(c, t): (c, t, None, None) for t in range(rng.randrange(4))})
    rows[200, None] = (200, None, None, None)
    rows = list(rows.values())
    assert result(spark, rows + [(None, 1, "u", "x")], size) == brute(rows)


def test_one_very_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "STRETCH", 4)
    rows = [(40, t, "u", f"w{t} x") for t in range(300)] + [(41, t, "u", f"w{t} x") for t in range(150)]
    assert result(spark, rows) == brute(rows)


def test_ends_of_a_node_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "PIECE", 50)
    rows = [(20 * i, 0, "u", "hi" if i % 3 else f"own {i}") for i in range(400)]
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    assert result(spark, []) == [] == result(spark, [(None, 0, "u", "x")])
    from pyspark.sql import functions as F

    clash = ("at", "a", "b", "words", "place", "h", "head", "x", "y", "depth", "owner", "CONV", "block", "_")
    rows = [(20, 0, "u", "a b"), (20, 1, "s", "c"), (21, 0, "u", "d")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in clash])
    assert sorted(map(tuple, convtrie.prefix_trie(df).collect()), key=str) == brute(rows)


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(20, 0, "u", "a b")] * 3
    got = result(spark, rows)
    assert [r[1:7] for r in sorted(got, key=lambda r: r[1])] == [(d, None if d == 0 else 20, 1, int(d < 3), 1, 0) for d in range(4)]
