"""Hour-of-day anomaly scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsignal.config import Config, DEFAULT
from opsignal.functions.clock import time_context
from opsignal.functions.rounding import round_half_up


def hourly_baseline(df: DataFrame) -> DataFrame:
    """Exactly 24 rows ``(hour, count, mean, std)``; hours without signals count 0."""
    return _baseline(df.groupBy("hour").agg(F.count("*").alias("n")))


def baseline_of_hours(hours: DataFrame) -> DataFrame:
    """The same from counts per clock hour ``(hour_start, signals)``, of any number of runs: their sums."""
    return _baseline(hours.groupBy(F.hour("hour_start").alias("hour")).agg(F.sum("signals").alias("n")))


def _baseline(counts: DataFrame) -> DataFrame:
    spine = counts.sparkSession.range(0, 24, 1, 1).select(F.col("id").cast("int").alias("hour"))
    # 24 rows by construction, whatever the input size.
    whole = Window.partitionBy(F.lit(1))
    return (
        spine.join(counts, "hour", "left")
        .select("hour", F.coalesce("n", F.lit(0).cast("bigint")).alias("count"))
        .withColumn("mean", F.avg("count").over(whole))
        .withColumn("std", F.stddev_pop("count").over(whole))
    )


def z_score(count: Column, mean: Column, std: Column, cfg: Config = DEFAULT) -> Column:
    clip = F.lit(cfg.z_clip)
    # greatest and least skip nulls, so equal counts are decided before the division.
    raw = F.try_divide(count - mean, std)
    clipped = round_half_up(F.greatest(-clip, F.least(clip, raw)))
    return F.when(std == 0, F.lit(0.0)).otherwise(clipped)


def anomaly_score(z: Column, is_business: Column, cfg: Config = DEFAULT) -> Column:
    base = F.least(F.abs(z) / F.lit(cfg.z_clip), F.lit(1.0))
    raised = F.least(base * F.lit(cfg.off_hours_factor), F.lit(1.0))
    return round_half_up(F.when(is_business, base).otherwise(raised))


def score_anomalies(
    df: DataFrame, baseline: DataFrame | None = None, cfg: Config = DEFAULT
) -> DataFrame:
    """Append ``z_score, anomaly_score, is_anomalous, time_context`` to every row.

    The baseline has 24 rows, so the broadcast is bounded for any input.
    """
    stats = hourly_baseline(df) if baseline is None else baseline
    stats = stats.select(
        "hour",
        F.col("count").alias("signals_this_hour"),
        z_score(F.col("count"), F.col("mean"), F.col("std"), cfg).alias("z_score"),
    )
    return df.join(F.broadcast(stats), "hour").withColumns(
        {
            "anomaly_score": anomaly_score(F.col("z_score"), F.col("is_business_hours"), cfg),
            "is_anomalous": F.abs("z_score") >= F.lit(cfg.z_threshold),
            "time_context": time_context(F.col("is_business_hours")),
        }
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Flagged count and mean score per time context, 0 where there is none."""

    def mean_if(flag: Column) -> Column:
        # Sum integer units so that the mean does not depend on row order.
        units = F.round(F.col("anomaly_score").cast("decimal(18,9)") * 10000, 0).cast("bigint")
        total = F.sum(F.when(flag, units))
        n = F.count(F.when(flag, 1))
        return F.when(n > 0, round_half_up(total / n / F.lit(1e4), 4)).otherwise(F.lit(0.0))

    biz = F.col("time_context") == "business_hours"
    return scored.agg(
        F.count("*").alias("signals"),
        F.count(F.when(F.col("is_anomalous"), 1)).alias("anomalous"),
        mean_if(biz).alias("avg_business_hours"),
        mean_if(~biz).alias("avg_off_hours"),
    )


def peak_hour(scored: DataFrame) -> DataFrame:
    """Hour with the highest mean anomaly score; the smallest on a tie."""
    units = F.round(F.col("anomaly_score").cast("decimal(18,9)") * 10000, 0).cast("bigint")
    hours = scored.groupBy("hour").agg(
        (F.sum(units) / F.count("*") / F.lit(1e4)).alias("mean_score")
    )
    return hours.orderBy(F.desc("mean_score"), "hour").limit(1).select(
        "hour", round_half_up(F.col("mean_score")).alias("mean_score")
    )


def incident_anomaly(scored: DataFrame) -> DataFrame:
    """Highest anomaly score of every incident."""
    return scored.groupBy("incident_group").agg(F.max("anomaly_score").alias("max_anomaly_score"))


def incident_anomaly_for(incidents: DataFrame, scored: DataFrame) -> DataFrame:
    """The same for a list of incidents; one without signals gets 0."""
    wanted = incidents.select("incident_group").distinct()
    return wanted.join(incident_anomaly(scored), "incident_group", "left").select(
        "incident_group",
        F.coalesce("max_anomaly_score", F.lit(0.0)).alias("max_anomaly_score"),
    )
