"""Ranks, cuts and first rows that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.session import materialise

_SEQ_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Exact 1..n over all rows in ``order`` (make it unique with an id).

    A range-partitioned sort numbers the rows inside each partition; the sorted
    rows are written once so that both uses see the same partitions, and the
    partition sizes, one row per partition, give the offsets.
    """
    tagged = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = materialise(tagged, "ranked").select(
        "*",
        F.shiftright("_at", _SEQ_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _SEQ_BITS) - 1)).alias("_seq"),
    )
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        kept.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_seq") + 1)
        .drop("_at", "_part", "_seq", "_off")
    )


def first_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each group in ``order``: a map-side combined minimum, no group sort."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def stratified_cut(df: DataFrame, label: str, fraction: float, id_col: str = "signal_id") -> DataFrame:
    """Per label the md5 value (and id) of the last row of the test part.

    A histogram over the first 16 bits of the hash finds the bucket that holds
    the cut; only that bucket, 1/65536 of a label, is ranked.
    """
    hashed = df.select(label, id_col, F.md5(F.col(id_col).cast("string")).alias("_h")).withColumn(
        "_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int")
    )
    counts = hashed.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    by_label = Window.partitionBy(label)
    upto = by_label.orderBy("_b")
    want = F.round(F.lit(fraction).cast("decimal(9,6)") * F.sum("_n").over(by_label), 0).cast("bigint")
    buckets = (
        counts.withColumns({"_cum": F.sum("_n").over(upto), "_want": want})
        .filter((F.col("_cum") >= F.col("_want")) & (F.col("_cum") - F.col("_n") < F.col("_want")))
        .select(label, "_b", (F.col("_want") - F.col("_cum") + F.col("_n")).alias("_need"))
    )
    inside = hashed.join(F.broadcast(buckets), [label, "_b"])
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_h", id_col))
    return (
        inside.withColumn("_nth", nth)
        .filter(F.col("_nth") == F.col("_need"))
        .select(label, F.struct("_h", F.col(id_col).alias("_id")).alias("_cut"))
    )


def stratified_split(
    df: DataFrame, label: str = "category", fraction: float = 0.2, id_col: str = "signal_id"
) -> DataFrame:
    """Append boolean ``is_test``: per label the first ``round(fraction * n)`` rows by md5 of the id.

    The cuts are one row per label of the closed label list.
    """
    cuts = stratified_cut(df, label, fraction, id_col)
    here = F.struct(
        F.md5(F.col(id_col).cast("string")).alias("_h"), F.col(id_col).alias("_id")
    )
    return (
        df.join(F.broadcast(cuts), label, "left")
        .withColumn("is_test", F.coalesce(here <= F.col("_cut"), F.lit(False)))
        .drop("_cut")
    )
