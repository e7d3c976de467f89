"""Candidate edges of the time window as an append stream: cells joined with their neighbours in time.

A cell is the signals of one category in one bucket as long as the window, as in the batch
operators. What the stream keeps of a cell are counts per digit of its signals' offsets, at
most 1024 of them under one level and prefix; a cell leaves the state when the watermark has
passed it and the bucket after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import BIG, pair_count
from opsignal.operators.timewindow import digits_of, micros, pairs_at_digit

_AT = ["category", "level", "prefix"]


def _buckets(cfg: Config) -> str:
    return f"{cfg.window_minutes} minutes"


def digit_lists(signals: DataFrame, delay: str, cfg: Config = DEFAULT, name: str = "") -> DataFrame:
    """``bucket`` (a time window), ``category, level, prefix, digits`` of final buckets; columns end in ``name``.

    Two aggregations: equal digits are counted map-side, then put side by side. Everything is
    named before the watermark, so that a stream can be joined with itself: two sides that share
    columns share a watermark, and one of them never moves.
    """
    time = F.col("timestamp").alias(f"timestamp{name}")
    named = signals.select(time, F.col("category").alias(f"category{name}")).withWatermark(f"timestamp{name}", delay)
    offset = F.pmod(micros(f"timestamp{name}"), F.lit(cfg.window_micros))
    digit = F.inline(digits_of(offset, cfg)).alias(f"level{name}", f"prefix{name}", "digit")
    at = [f"{c}{name}" for c in _AT]
    counts = (
        named.select(f"timestamp{name}", at[0], digit)
        .groupBy(F.window(f"timestamp{name}", _buckets(cfg)).alias(f"bucket{name}"), *at, "digit")
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy(F.window(f"bucket{name}", _buckets(cfg)).alias(f"bucket{name}"), *at).agg(
        F.collect_list(F.struct("digit", "n")).alias(f"digits{name}")
    )


def edges_inside(signals: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Edges of cells with themselves: all pairs of a bucket are within the window."""
    cells = signals.groupBy(F.window("timestamp", _buckets(cfg)).alias("bucket"), "category").agg(F.count("*").alias("n"))
    start = F.col("bucket.start")
    return cells.select("category", start.alias("early_start"), start.alias("late_start"), pair_count(F.col("n")).cast(BIG).alias("pairs"))


def edges_across(signals: DataFrame, delay: str, cfg: Config = DEFAULT) -> DataFrame:
    """Edges of cells with that of the next bucket, by an interval join of the stream with itself.

    Both sides carry the watermark and their times are one bucket apart, so that each side's
    state ends one bucket after its own time. Digits decide disjoint sets of pairs; their
    numbers are summed per cell.
    """
    early = digit_lists(signals, delay, cfg).withColumn("at", F.window_time("bucket"))
    late = digit_lists(signals, delay, cfg, "_l").withColumn("at_l", F.window_time("bucket_l"))
    apart = F.expr(f"INTERVAL {_buckets(cfg)}")
    near = (F.col("at_l") >= F.col("at") + apart) & (F.col("at_l") <= F.col("at") + apart)
    for c in _AT:
        near &= F.col(c) == F.col(f"{c}_l")
    met = early.join(late, near).select("at", "category", pairs_at_digit("digits", "digits_l").alias("pairs"))
    summed = met.groupBy(F.window("at", _buckets(cfg)).alias("bucket"), "category").agg(F.sum("pairs").cast(BIG).alias("pairs"))
    return summed.select(
        "category", F.col("bucket.start").alias("early_start"), F.col("bucket.end").alias("late_start"), "pairs"
    )


def edge_stream(signals: DataFrame, delay: str = "30 minutes", cfg: Config = DEFAULT) -> DataFrame:
    """``category, early_start, late_start, pairs``: every candidate edge once, in append mode.

    An edge joins the cells of one category in two buckets (or one with itself) and counts the
    pairs of their signals that are at most the window apart; there are two edges a cell at most.
    It is final when the watermark, ``delay`` behind the latest signal, has passed the later
    bucket. Signals without a category or time belong to no cell.
    """
    good = signals.filter("category IS NOT NULL AND timestamp IS NOT NULL").select("category", "timestamp")
    inside = edges_inside(good.withWatermark("timestamp", delay), cfg)
    return inside.unionByName(edges_across(good, delay, cfg)).filter("pairs > 0")
