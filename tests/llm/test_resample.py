import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from opsignal.llm import resample

SCHEMA = "doc_id long, text string"


def buckets(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    grams = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(docs, target):
    made = [(i, *buckets(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, b in made:
        s.update(b)
    for x in target:
        t.update(buckets(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))

    rows = []
    for i, n, b in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, b))
        rows.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: 5 * len(able) // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in rows), key=str)


def result(spark, docs, target):
    docs = spark.createDataFrame(docs, SCHEMA).repartition(3)
    target = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(map(tuple, resample.resample(docs, target).collect()), key=str)


def test_checksums_of_spans():
    rng = random.Random(1)
    data = np.frombuffer(rng.randbytes(200_000), np.uint8)
    starts = np.array([rng.randrange(100_000) for _ in range(500)])
    sizes = np.array([rng.choice([1, 2, 5, 63, 64, 65, 128, 129, 1000, 70_000]) for _ in range(500)])
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, sizes)]
    assert resample.span_checksums(data, starts, starts + sizes).tolist() == want
    short = sizes <= resample.DISTANCES
    got = resample.span_checksums(data, starts[short], (starts + sizes)[short])
    assert got.tolist() == [w for w, s in zip(want, short) if s]


def test_features_of_texts():
    texts = ["Hello World, foo-bar É a", "", None, "x" * 3000 + " yy " + "z" * 100, "a", "a b", "1 2 3 4", "Ä_b\x7fc`d"]
    got = Counter()
    for text, bucket in resample._features(pa.array(texts)):
        got.update(zip(text.tolist(), bucket.tolist()))
    assert got == Counter((i, b) for i, t in enumerate(texts) for b in buckets(t)[1])


def test_equals_plain_computation(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)] + ["Straße", "X9"]
    docs = [(i, " ".join(rng.choice(vocabulary[: 20 + i]) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(1000 + i, "one text many times " * 6) for i in range(50)]  # ties but for the noise
    docs += [(None, None), (None, "no number " * 15), (7, ""), (8, " \n ")]
    target = [" ".join(rng.choice(vocabulary[:15]) for _ in range(30)) for _ in range(20)] + [None, ""]
    got = result(spark, docs, target)
    assert got == brute(docs, target)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 1 + 5 * sum(buckets(t)[0] >= 20 for _, t in docs) // 100))


def test_repeated_rows_and_empty_tables(spark, edge_docs, no_docs):
    same = [(1, "word " * 25)] * 100
    got = result(spark, same, ["word"])
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3, 4, 5] and len({r[:4] for r in got}) == 1
    assert resample.resample(no_docs, no_docs).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = resample.resample(edge_docs, no_docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [])
