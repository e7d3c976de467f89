"""Sharding by extendible hashing: only buckets over the byte limit split on a further bit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.llm.common import materialise

HASH_BITS = 60


def _prefix(hash_column: Column, depth: Column | int) -> Column:
    """The first ``depth`` of the hash's 60 bits as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", hash_column, F.lit(HASH_BITS) - depth.cast("int"))


def directory(sizes: DataFrame, limit: int, step: int = 12) -> DataFrame:
    """Leaf buckets ``(depth, prefix, shard_rows, shard_bytes)`` of rows ``(h, bytes)``.

    Bits are opened ``step`` at a time. In a round, the rows of the buckets still too large
    are summed by prefix at its deepest level (map-side first, so a bucket sends at most one
    row per task), the sums are rolled up to every depth of the round, and each prefix takes
    the least depth at which it fits. What fits nowhere goes on to the next round; at the last
    bit only rows of one hash are left, which stay one bucket whatever its size.
    """
    leaves, todo, base = None, sizes, 0
    while True:
        deep = min(base + step, HASH_BITS)
        cells = todo.groupBy(_prefix(F.col("h"), deep).alias("cell")).agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        cells = materialise(cells, "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep))))
        sums = levels.groupBy("depth", F.call_function("shiftright", F.col("cell"), F.lit(deep) - F.col("depth")).alias("prefix")).agg(
            F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
        )
        fits = (F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS)
        # a leaf is a fitting prefix whose parent does not fit (the root has none)
        parents = sums.filter(~fits).select((F.col("depth") + 1).alias("p_depth"), F.col("prefix").alias("p_prefix"))
        ok = sums.filter(fits)
        under = ok.join(parents, F.expr("depth = p_depth AND shiftright(prefix, 1) = p_prefix"), "left_semi")
        if base == 0:
            under = under.unionByName(ok.filter("depth = 0"))
        found = materialise(under, "leaves")
        leaves = found if leaves is None else leaves.unionByName(found)
        if deep == HASH_BITS:
            break
        large = materialise(
            sums.filter((F.col("depth") == deep) & ~fits).select(F.col("prefix").alias("cell")), "large"
        )
        if large.isEmpty():
            break
        todo = todo.withColumn("cell", _prefix(F.col("h"), deep)).join(large, "cell", "left_semi").drop("cell")
        base = deep
    return leaves.select("depth", "prefix", F.col("n").alias("shard_rows"), F.col("bytes").alias("shard_bytes"))


def shard_documents(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, bytes, shard, depth, shard_rows, shard_bytes)``, one row per document.

    The bucket of a row is the hash of its key and text: copies of a row share a bucket and rows
    of one hot key do not. ``shard`` is the bucket's bit string (empty for an unsplit table);
    its bytes are the UTF-8 bytes of its texts and keep to ``limit``, unless a single text, or
    copies of one row, are larger. Null key or text hash as nulls and weigh nothing. Empty
    table: no rows. Further columns are not read.
    """
    h = F.call_function("shiftrightunsigned", F.xxhash64(F.col(key), F.col(text)), F.lit(64 - HASH_BITS))
    rows = docs.select(F.col(key), h.alias("h"), F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0)).alias("bytes"))
    rows = materialise(rows, "hashes")  # the texts are read once; from here on a row is three numbers
    leaves = materialise(directory(rows.select("h", "bytes", F.lit(1).alias("n")), limit), "directory")
    depths = [r[0] for r in leaves.select("depth").distinct().collect()]  # at most 61
    # a prefix and its depth name a bucket; a row is asked for each depth in use and meets exactly one leaf
    asked = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in sorted(depths)]))) if depths else rows.withColumn("depth", F.lit(0))
    asked = asked.withColumn("prefix", _prefix(F.col("h"), F.col("depth")))
    met = asked.join(leaves, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth").cast("int"), F.lit("0")))
    return met.select(key, "bytes", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_rows", "shard_bytes")
