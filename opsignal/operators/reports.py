"""Counts, distributions, filters and rankings behind reports and dashboards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.rounding import round_half_up, to_units


def with_prefix(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows whose ``column`` starts with any of the prefixes (pushed to the scan)."""
    return df.filter(reduce(lambda a, b: a | b, (F.col(column).startswith(p) for p in prefixes)))


def in_categories(df: DataFrame, categories, column: str = "predicted_category") -> DataFrame:
    return df.filter(F.col(column).isin(*categories))


def time_spans(df: DataFrame, key: str) -> DataFrame:
    span = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(6e7)
    return df.groupBy(key).agg(round_half_up(span, 2).alias("time_span_minutes"))


def category_by_source(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Counts per category, one zero-filled column per source, by total."""
    sources = list(cfg.source_weights)
    counts = [F.count(F.when(F.col("source_type") == s, 1)).alias(s) for s in sources]
    total = reduce(lambda a, b: a + b, (F.col(s) for s in sources))
    return df.groupBy("category").agg(*counts).orderBy(total, "category")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(field, value, n)`` for several columns from one scan."""
    pairs = F.array(
        *(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns)
    )
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct counts without expanding rows once per column.

    Incidents are first reduced to one row each, with the categories seen in it.
    """
    per_incident = df.groupBy("incident_group", "category").agg(F.count("*").alias("n"))
    return per_incident.agg(
        F.sum("n").alias("signals"),
        F.count_distinct("incident_group").alias("incidents"),
        F.count_distinct("category").alias("categories"),
    )


def closed_set(column: str) -> Column:
    """Sorted distinct values of a column with a closed list of values."""
    return F.sort_array(F.collect_set(column))


def mode_per_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """Most common value per group; on a tie the one whose first member id is smallest."""
    counts = df.groupBy(group, column).agg(F.count("*").alias("n"), F.min("signal_id").alias("first"))
    best = F.min_by(column, F.struct(-F.col("n"), "first"))
    return counts.groupBy(group).agg(best.alias(column))


def dataset_statistics(df: DataFrame) -> DataFrame:
    """Tall ``(metric, item, value)``; one scan, then only category x source counts."""
    cells = df.groupBy("category", "source_type").agg(F.count("*").alias("n"))

    def total(name: str, value: Column) -> DataFrame:
        return cells.agg(value.alias("value")).select(
            F.lit(name).alias("metric"), F.lit("").alias("item"), "value"
        )

    def spread(name: str, column: str) -> DataFrame:
        return cells.groupBy(column).agg(F.sum("n").alias("value")).select(
            F.lit(name).alias("metric"), F.col(column).alias("item"), "value"
        )

    parts = [
        total("total_signals", F.coalesce(F.sum("n"), F.lit(0))),
        total("categories", F.count_distinct("category")),
        total("source_types", F.count_distinct("source_type")),
        spread("category_distribution", "category"),
        spread("source_distribution", "source_type"),
    ]
    return reduce(DataFrame.unionByName, parts)


def most_anomalous(scored: DataFrame, k: int = 5) -> DataFrame:
    columns = ["signal_id", "hour", "time_context", "z_score", "anomaly_score", "is_anomalous"]
    return scored.select(*columns).orderBy(F.desc("anomaly_score"), "signal_id").limit(k)


def _mean(column: str) -> Column:
    return F.sum(to_units(F.col(column))) / F.count("*") / F.lit(1e4)


def above_mean(df: DataFrame, column: str) -> DataFrame:
    """Every row against the overall mean, which is one broadcast row."""
    mean = df.agg(_mean(column).alias("_mean"))
    return (
        df.join(F.broadcast(mean), F.lit(True))
        .withColumn("above_mean", round_half_up(F.col(column) - F.col("_mean")))
        .drop("_mean")
    )


def best_category(scored: DataFrame) -> DataFrame:
    """Mean score per category of the closed list, the highest marked."""
    means = scored.groupBy("category").agg(round_half_up(_mean("anomaly_score")).alias("mean_score"))
    top = Window.partitionBy(F.lit(1)).orderBy(F.desc("mean_score"))
    return means.withColumn("best", F.rank().over(top) == 1)


def _values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, so that sets are compared by value and no row of a frequent one meets another."""
    return df.select(F.col(column).alias("value")).distinct()


def only_left(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in ``left`` that ``right`` lacks; nulls compare equal."""
    return _values(left, column).subtract(_values(right, column))


def in_both(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return _values(left, column).intersect(_values(right, column))


def confidence_histogram(groups: DataFrame, bins: int = 14) -> DataFrame:
    """``(predicted_category, bin, groups)``: equal bins on [0, 1], the last one closed."""
    at = F.least(F.floor(F.col("confidence_score") * bins), F.lit(bins - 1)).cast("int")
    return groups.groupBy("predicted_category", at.alias("bin")).agg(F.count("*").alias("groups"))
