"""Time features and the source weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.config import Config, DEFAULT


def business_hours(ts: Column, cfg: Config = DEFAULT) -> Column:
    first, last = cfg.business_hours
    return F.hour(ts).between(first, last) & F.weekday(ts).between(0, 4)


def time_context(flag: Column) -> Column:
    return F.when(flag, F.lit("business_hours")).otherwise(F.lit("off_hours"))


def gap_minutes(a: Column, b: Column) -> Column:
    """Absolute gap of two timestamps in fractional minutes."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / F.lit(6e7)


def parse_timestamp(col: Column, strict: bool = True) -> Column:
    """Strict parsing stops the job on bad text; the other form gives null."""
    return F.to_timestamp(col) if strict else F.try_to_timestamp(col)


def with_time_features(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    ts = F.col("timestamp").cast("timestamp")
    return df.withColumns(
        {
            "timestamp": ts,
            "hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "is_business_hours": business_hours(ts, cfg),
        }
    )


def source_weight(col: Column, cfg: Config = DEFAULT) -> Column:
    """Reliability of a source; an unknown source weighs nothing."""
    pairs = [F.lit(x) for item in cfg.source_weights.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(0.0))


def with_source_weight(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return df.withColumn("source_weight", source_weight(F.col("source_type"), cfg))
