"""Counting signal pairs within a time window without listing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import BIG, pair_count, pair_product

# A bucket is as long as the window, so two signals of one bucket are always within
# the window and signals of buckets that do not touch never are. What remains are
# neighbouring buckets: offsets u (earlier) and v (later) fit when v <= u.
_DIGIT_BITS = 10


def micros(col: str = "timestamp") -> Column:
    return F.unix_micros(col)


def with_bucket(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    t = micros()
    width = F.lit(cfg.window_micros)
    return df.withColumns({"bucket": F.floor(t / width), "offset": F.pmod(t, width)})


def digits_of(offset: Column, cfg: Config = DEFAULT) -> Column:
    """``array<(level, prefix, digit)>``: an offset read as base-1024 digits, each with the digits above it."""
    levels = max(1, -(-(cfg.window_micros - 1).bit_length() // _DIGIT_BITS))
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("level"),
                F.shiftright(offset, _DIGIT_BITS * (i + 1)).alias("prefix"),
                F.shiftright(offset, _DIGIT_BITS * i).bitwiseAND(F.lit((1 << _DIGIT_BITS) - 1)).alias("digit"),
            )
            for i in range(levels)
        )
    )


def offset_digits(rows: DataFrame, cell: str, cfg: Config = DEFAULT) -> DataFrame:
    """``(cell, level, prefix, digits)``: how many rows of a cell carry each digit of their offset.

    ``digits`` holds at most 1024 entries however many rows the cell has, and rows are
    summed map-side.
    """
    return (
        rows.select(cell, F.inline(digits_of(F.col("offset"), cfg)))
        .groupBy(cell, "level", "prefix", "digit")
        .agg(F.count("*").alias("n"))
        .groupBy(cell, "level", "prefix")
        .agg(F.collect_list(F.struct("digit", "n")).alias("digits"))
    )


def pairs_at_digit(early: str, late: str) -> Column:
    """Pairs of an earlier and a later cell that this digit decides: the later offset is smaller.

    Equal offsets count at the lowest digit. Both columns hold ``(digit, n)`` under one
    level and prefix.
    """

    def later_at_or_below(e: Column) -> Column:
        """Rows of the later cell that fit one digit of the earlier; a plain count."""
        fits = F.filter(
            late,
            lambda x: (x["digit"] < e["digit"]) | ((F.col("level") == 0) & (x["digit"] == e["digit"])),
        )
        return F.aggregate(fits, F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])

    return F.aggregate(
        early,
        F.lit(0).cast(BIG),
        lambda acc, e: (acc + pair_product(later_at_or_below(e), e["n"])).cast(BIG),
    )


def partial_pairs(links: DataFrame, rows: DataFrame, cell: str, cfg: Config = DEFAULT) -> DataFrame:
    """``(early, late, pairs)``: pairs with late offset <= early offset, per link of two cells.

    Two offsets compare at the highest digit in which they differ; digits above it
    are the join key. Equal offsets count at the lowest digit.
    """
    wanted = links.select(F.col("early").alias(cell)).unionByName(links.select(F.col("late").alias(cell)))
    digits = offset_digits(rows.join(wanted.distinct(), cell, "left_semi"), cell, cfg)
    left = digits.select(F.col(cell).alias("early"), "level", "prefix", F.col("digits").alias("d_e"))
    right = digits.select(F.col(cell).alias("late"), "level", "prefix", F.col("digits").alias("d_l"))
    return (
        links.join(left, "early")
        .join(right, ["late", "level", "prefix"])
        .groupBy("early", "late")
        .agg(F.sum(pairs_at_digit("d_e", "d_l")).cast(BIG).alias("pairs"))
    )


def window_pair_counts(df: DataFrame, keys: list[str], cfg: Config = DEFAULT) -> DataFrame:
    """Pairs of signals with equal ``keys`` and a gap within the window, per key.

    The result counts what an interval join would list. Rows with a null key never match.
    """
    return bucket_pair_counts(df, keys, cfg).groupBy(*keys).agg(F.sum("pairs").cast(BIG).alias("pairs"))


def bucket_pair_counts(df: DataFrame, keys: list[str], cfg: Config = DEFAULT) -> DataFrame:
    """The pairs of ``window_pair_counts`` per key and bucket of the earlier signal.

    A pair across a bucket border belongs to the bucket before the border.
    """
    edges = cell_edges(df, keys, cfg)
    return edges.groupBy(*keys, F.col("early").alias("bucket")).agg(F.sum("pairs").cast(BIG).alias("pairs"))


def cell_edges(df: DataFrame, keys: list[str], cfg: Config = DEFAULT) -> DataFrame:
    """``(*keys, early, late, pairs)``: candidate edges between cells, the signals of one key and bucket.

    An edge joins a cell with itself or with that of the next bucket and carries the exact
    number of signal pairs within the window that it stands for (0: none, the edge is kept
    out), so there are at most two edges a cell, however many signals it holds.
    """
    rows = with_bucket(df, cfg)
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    rows = rows.withColumn("cell", F.concat_ws("\u0001", *(F.col(k).cast("string") for k in [*keys, "bucket"])))
    cells = rows.groupBy(*keys, "bucket", "cell").agg(
        F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")
    )
    after = cells.select(
        *keys,
        (F.col("bucket") - 1).alias("bucket"),
        F.col("cell").alias("late"),
        F.col("n").alias("n_l"),
        F.col("lo").alias("lo_l"),
        F.col("hi").alias("hi_l"),
    )
    near = cells.withColumnRenamed("cell", "early").join(after, [*keys, "bucket"]).filter("lo_l <= hi")
    whole = near.filter("hi_l <= lo").select(*keys, "bucket", pair_product(F.col("n"), F.col("n_l")).alias("pairs"))
    split = near.filter("hi_l > lo")
    part = split.join(partial_pairs(split.select("early", "late"), rows, "cell", cfg), ["early", "late"])
    across = whole.unionByName(part.select(*keys, "bucket", "pairs"))
    inside = cells.select(*keys, "bucket", F.col("bucket").alias("late"), pair_count(F.col("n")).cast(BIG).alias("pairs"))
    both = inside.unionByName(across.withColumn("late", F.col("bucket") + 1).select(*inside.columns))
    return both.filter("pairs > 0").withColumnRenamed("bucket", "early")
