from pyspark.sql import functions as F

from opsignal.llm import sharding


def brute(rows, limit, depth=0):
    """Leaf bit strings by splitting whatever is too large."""
    if sum(b for _, b in rows) <= limit or depth == 60 or not rows:
        return {bits[:depth] for bits, _ in rows}
    out = set()
    for bit in "01":
        out |= brute([r for r in rows if r[0][depth] == bit], limit, depth + 1)
    return out


def test_only_oversized_buckets_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    h = docs.select(F.xxhash64("doc_id", "text").alias("h"), F.octet_length("text").alias("b")).collect()
    rows = [(format((r["h"] % 2**64) >> 4, "060b"), r["b"] or 0) for r in h]
    for limit in (10_000, 60_000, 10**9):
        got = sharding.shard_documents(docs, limit).collect()
        assert len(got) == docs.count()
        assert {r["shard"] for r in got} == brute(rows, limit)
        sums = {}
        for r in got:
            sums[r["shard"]] = sums.get(r["shard"], 0) + r["bytes"]
            assert len(r["shard"]) == r["depth"]
        assert all(sums[r["shard"]] == r["shard_bytes"] for r in got)
        largest = max(b for _, b in rows)
        assert all(b <= max(limit, largest) for b in sums.values())


def test_edges(spark, edge_docs, no_docs):
    got = sharding.shard_documents(edge_docs, 100).collect()
    assert len(got) == edge_docs.count()
    assert all(r["shard_bytes"] <= 100 or r["bytes"] == r["shard_bytes"] for r in got)
    assert sharding.shard_documents(no_docs, 100).collect() == []


def test_hot_copies_stay_one_bucket(spark):
    docs = spark.range(40).selectExpr("1L AS doc_id", "repeat('z', 50) AS text")
    got = sharding.shard_documents(docs, 100).collect()
    assert {(r["depth"], r["shard_bytes"]) for r in got} == {(60, 2000)}
