"""Queries on rows and aggregates: checks, time features, anomaly scores, ranks, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsignal.config import DEFAULT, REQUIRED_COLUMNS
from opsignal.functions import clock
from opsignal.functions.rounding import round_half_up
from opsignal.operators import anomaly, preprocess, ranking, reports, validate
from opsignal.plans import checksql as C
from opsignal.plans.registry import query
from opsignal.sources import views


def events(spark, sf):
    return views.signals(spark, sf, "event_signals")


def timed(spark, sf):
    return clock.with_source_weight(clock.with_time_features(events(spark, sf)))


def scored(spark, sf):
    return anomaly.score_anomalies(timed(spark, sf))


def rounded(df):
    return df.withColumns({c: round_half_up(F.col(c), 6) for c in ("mean", "std")})


def dirty(spark, sf):
    """The event signals with the faults a feed can have, made from the event type and id."""
    number = F.substring("signal_id", 5, 8).cast("int")
    return events(spark, sf).withColumns(
        {
            "source_type": F.when(number % 4 == 3, F.concat(F.lit("pager"), (number % 7).cast("string")))
            .when(number % 11 == 5, F.lit(None).cast("string"))
            .otherwise(F.col("source_type")),
            "category": F.when(number % 13 == 1, F.lit("Unknown")).otherwise(F.col("category")),
            "text": F.when(number % 17 == 2, F.lit(None).cast("string")).otherwise(F.col("text")),
        }
    )


DIRTY = """dirty AS (SELECT signal_id,
 CASE WHEN k % 4 = 3 THEN concat('pager', CAST(k % 7 AS STRING)) WHEN k % 11 = 5 THEN NULL
  ELSE source_type END AS source_type,
 CASE WHEN k % 13 = 1 THEN 'Unknown' ELSE category END AS category,
 CASE WHEN k % 17 = 2 THEN NULL ELSE text END AS text, timestamp, incident_group
 FROM (SELECT *, CAST(substr(signal_id, 5, 8) AS INTEGER) AS k FROM event_signals))"""

HOURS = "CAST(hour(timestamp) AS INTEGER)"
TIMED = f"""timed AS (SELECT *, {HOURS} AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
 (hour(timestamp) BETWEEN 8 AND 17) AND (isodow(timestamp) BETWEEN 1 AND 5) AS is_business_hours,
 {C.SOURCE_WEIGHT.format(c='source_type')} AS source_weight FROM event_signals)"""


def scored_ctes(source: str) -> tuple[str, ...]:
    return (
        f"""baseline AS (SELECT hour, count, avg(count) OVER () AS mean, stddev_pop(count) OVER () AS std
 FROM (SELECT CAST(r.range AS INTEGER) AS hour, count(t.signal_id) AS count
 FROM range(24) r LEFT JOIN {source} t ON t.hour = r.range GROUP BY 1))""",
        f"""zscores AS (SELECT hour, count AS signals_this_hour, CASE WHEN std = 0 THEN 0.0::DOUBLE
 ELSE {C.rnd('greatest(-3.0, least(3.0, (count - mean) / std))')} END AS z_score FROM baseline)""",
        f"""scored AS (SELECT t.*, z.signals_this_hour, z.z_score,
 {C.rnd('least(least(abs(z.z_score) / 3.0, 1.0) * CASE WHEN is_business_hours THEN 1.0 ELSE 1.3 END, 1.0)')}
  AS anomaly_score,
 abs(z.z_score) >= 2.0 AS is_anomalous,
 CASE WHEN is_business_hours THEN 'business_hours' ELSE 'off_hours' END AS time_context
 FROM {source} t JOIN zscores z ON t.hour = z.hour)""",
    )


EVENT = C.with_(C.EVENT)
EVENT_TIMED = C.with_(C.EVENT, TIMED)
EVENT_SCORED = C.with_(C.EVENT, TIMED, *scored_ctes("timed"))
REPORT = """SELECT * FROM (SELECT 'Required columns present' AS check_name, true AS passed
 UNION ALL SELECT 'source_type values valid', count(*) = 0 FROM {t}
  WHERE source_type IS NULL OR source_type NOT IN ('alert', 'ticket', 'log')
 UNION ALL SELECT 'category values valid', count(*) = 0 FROM {t}
  WHERE category IS NULL OR category NOT IN ({c})
 UNION ALL SELECT 'No nulls in required columns', count(*) = 0 FROM {t}
  WHERE signal_id IS NULL OR source_type IS NULL OR category IS NULL OR text IS NULL
   OR timestamp IS NULL OR incident_group IS NULL)"""


@query("q_v1_validate_schema", EVENT + REPORT.format(t="event_signals", c=C.CATEGORY_LIST))
def v1(spark, sf):
    return validate.validation_report(events(spark, sf))


@query("q_v1_validate_faulty", C.with_(C.EVENT, DIRTY) + REPORT.format(t="dirty", c=C.CATEGORY_LIST))
def v1_faulty(spark, sf):
    return validate.validation_report(dirty(spark, sf))


@query(
    "q_v2_bad_values",
    C.with_(C.EVENT, DIRTY)
    + """SELECT source_type AS bad_value, count(*) AS n FROM dirty
 WHERE source_type IS NULL OR source_type NOT IN ('alert', 'ticket', 'log') GROUP BY 1""",
)
def v2(spark, sf):
    return validate.bad_values(dirty(spark, sf), "source_type", DEFAULT.source_weights)


@query(
    "q_v3_null_census",
    C.with_(C.EVENT, DIRTY)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM dirty" for c in REQUIRED_COLUMNS
    ),
)
def v3(spark, sf):
    return validate.null_census(dirty(spark, sf))


@query(
    "q_v4_fail_fast_gate",
    EVENT + "SELECT source_type, count(signal_id) AS n FROM event_signals GROUP BY 1",
)
def v4(spark, sf):
    return (
        validate.require_valid(events(spark, sf))
        .groupBy("source_type")
        .agg(F.count("signal_id").alias("n"))
    )


@query(
    "q_v4_quarantine",
    C.with_(C.EVENT, DIRTY)
    + f"""SELECT signal_id, source_type, category FROM dirty
 WHERE source_type IS NULL OR source_type NOT IN ('alert', 'ticket', 'log')
  OR category IS NULL OR category NOT IN ({C.CATEGORY_LIST}) OR text IS NULL""",
)
def v4_quarantine(spark, sf):
    _, bad = validate.split_valid(dirty(spark, sf))
    return bad.select("signal_id", "source_type", "category")


@query(
    "q_v6_membership_filter",
    EVENT
    + """SELECT signal_id, category FROM event_signals WHERE signal_id IN
 (SELECT concat('EVT-', lpad(CAST(doc_id AS STRING), 8, '0')) FROM labels WHERE toxic = 1)""",
)
def v6(spark, sf):
    wanted = (
        views.table(spark, sf, "labels")
        .filter("toxic = 1")
        .select(F.concat(F.lit("EVT-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("signal_id"))
    )
    return events(spark, sf).join(wanted, "signal_id", "left_semi").select("signal_id", "category")


@query(
    "q_v7_prefix_filter",
    EVENT
    + """SELECT signal_id, incident_group FROM event_signals
 WHERE starts_with(incident_group, 'INC-1') OR starts_with(incident_group, 'INC-22-')""",
)
def v7(spark, sf):
    return reports.with_prefix(events(spark, sf), "incident_group", ["INC-1", "INC-22-"]).select(
        "signal_id", "incident_group"
    )


@query(
    "q_v8_column_preview",
    EVENT_TIMED + "SELECT signal_id, source_type, source_weight, hour, is_business_hours FROM timed",
)
def v8(spark, sf):
    return timed(spark, sf).select("signal_id", "source_type", "source_weight", "hour", "is_business_hours")


@query("q_d0_parse_timestamp", EVENT + "SELECT signal_id, timestamp FROM event_signals")
def d0(spark, sf):
    as_text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events(spark, sf).select("signal_id", clock.parse_timestamp(as_text).alias("timestamp"))


@query(
    "q_d0_parse_lenient",
    EVENT
    + """SELECT signal_id, CASE WHEN source_type = 'log' THEN NULL ELSE timestamp END AS timestamp
 FROM event_signals""",
)
def d0_lenient(spark, sf):
    as_text = F.when(F.col("source_type") == "log", F.lit("not a time")).otherwise(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return events(spark, sf).select("signal_id", clock.parse_timestamp(as_text, False).alias("timestamp"))


@query("q_d1_hour_of_day", EVENT_TIMED + "SELECT hour, count(*) AS n FROM timed GROUP BY 1")
def d1(spark, sf):
    return timed(spark, sf).groupBy("hour").agg(F.count("*").alias("n"))


@query("q_d2_day_of_week", EVENT_TIMED + "SELECT day_of_week, count(*) AS n FROM timed GROUP BY 1")
def d2(spark, sf):
    return timed(spark, sf).groupBy("day_of_week").agg(F.count("*").alias("n"))


@query(
    "q_d3_business_hours",
    EVENT_TIMED + "SELECT is_business_hours, count(*) AS n FROM timed GROUP BY 1",
)
def d3(spark, sf):
    return timed(spark, sf).groupBy("is_business_hours").agg(F.count("*").alias("n"))


@query(
    "q_d4_time_context",
    EVENT_TIMED
    + """SELECT signal_id, CASE WHEN is_business_hours THEN 'business_hours' ELSE 'off_hours' END
 AS time_context FROM timed""",
)
def d4(spark, sf):
    return timed(spark, sf).select(
        "signal_id", clock.time_context(F.col("is_business_hours")).alias("time_context")
    )


@query(
    "q_d5_gap_minutes",
    EVENT
    + f"""SELECT e.signal_id, {C.rnd("abs(epoch_us(e.timestamp) - epoch_us(f.first)) / 6e7::DOUBLE")}
 AS gap FROM event_signals e JOIN (SELECT incident_group, min(timestamp) AS first
 FROM event_signals GROUP BY 1) f ON e.incident_group = f.incident_group""",
)
def d5(spark, sf):
    df = events(spark, sf)
    first = df.groupBy("incident_group").agg(F.min("timestamp").alias("first"))
    return df.join(first, "incident_group").select(
        "signal_id", round_half_up(clock.gap_minutes(F.col("timestamp"), F.col("first"))).alias("gap")
    )


@query(
    "q_d6_time_span",
    EVENT
    + f"""SELECT incident_group,
 {C.rnd("(epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 6e7::DOUBLE", 2)} AS time_span_minutes
 FROM event_signals GROUP BY 1""",
)
def d6(spark, sf):
    return reports.time_spans(events(spark, sf), "incident_group")


@query(
    "q_d7_time_features",
    EVENT_TIMED + "SELECT signal_id, timestamp, hour, day_of_week, is_business_hours FROM timed",
)
def d7(spark, sf):
    return clock.with_time_features(events(spark, sf)).select(
        "signal_id", "timestamp", "hour", "day_of_week", "is_business_hours"
    )


@query(
    "q_w1_source_weight",
    C.with_(C.EVENT, DIRTY)
    + f"SELECT signal_id, {C.SOURCE_WEIGHT.format(c='source_type')} AS source_weight FROM dirty",
)
def w1(spark, sf):
    return clock.with_source_weight(dirty(spark, sf)).select("signal_id", "source_weight")


@query("q_a1_hourly_baseline", EVENT_SCORED + f"SELECT hour, count, {C.rnd('mean', 6)} AS mean, {C.rnd('std', 6)} AS std FROM baseline")
def a1(spark, sf):
    return rounded(anomaly.hourly_baseline(timed(spark, sf)))


@query("q_a2_z_score", EVENT_SCORED + "SELECT hour, z_score FROM zscores")
def a2(spark, sf):
    z = anomaly.z_score(F.col("count"), F.col("mean"), F.col("std"))
    return anomaly.hourly_baseline(timed(spark, sf)).select("hour", z.alias("z_score"))


@query("q_a3_anomaly_score", EVENT_SCORED + "SELECT signal_id, anomaly_score, is_anomalous FROM scored")
def a3(spark, sf):
    return scored(spark, sf).select("signal_id", "anomaly_score", "is_anomalous")


@query(
    "q_a4_score_all_signals",
    EVENT_SCORED
    + """SELECT signal_id, hour, signals_this_hour, z_score, anomaly_score, is_anomalous, time_context
 FROM scored""",
)
def a4(spark, sf):
    return scored(spark, sf).select(
        "signal_id", "hour", "signals_this_hour", "z_score", "anomaly_score", "is_anomalous", "time_context"
    )


def _mean_score(flag: str) -> str:
    total = f"CAST(coalesce(sum({C.units('anomaly_score')}) FILTER ({flag}), 0) AS DOUBLE)"
    n = f"count(*) FILTER ({flag})"
    return f"CASE WHEN {n} > 0 THEN {C.rnd(f'{total} / {n} / 10000::DOUBLE')} ELSE 0.0::DOUBLE END"


@query(
    "q_a5_anomaly_summary",
    EVENT_SCORED
    + f"""SELECT count(*) AS signals, count(*) FILTER (is_anomalous) AS anomalous,
 {_mean_score("time_context = 'business_hours'")} AS avg_business_hours,
 {_mean_score("time_context = 'off_hours'")} AS avg_off_hours FROM scored""",
)
def a5(spark, sf):
    return anomaly.anomaly_summary(scored(spark, sf))


@query(
    "q_a6_peak_hour",
    EVENT_SCORED
    + f"""SELECT hour, {C.rnd('m')} AS mean_score FROM (SELECT hour,
 CAST(sum({C.units('anomaly_score')}) AS DOUBLE) / count(*) / 10000::DOUBLE AS m FROM scored GROUP BY 1)
 ORDER BY m DESC, hour LIMIT 1""",
)
def a6(spark, sf):
    return anomaly.peak_hour(scored(spark, sf))


@query(
    "q_a7_incident_anomaly",
    EVENT_SCORED
    + """SELECT i.incident_group, coalesce(max(s.anomaly_score), 0.0) AS max_anomaly_score
 FROM (SELECT DISTINCT concat('INC-', CAST(c_custkey AS STRING), '-2024-01-05') AS incident_group
  FROM customer) i LEFT JOIN scored s ON i.incident_group = s.incident_group GROUP BY 1""",
)
def a7(spark, sf):
    wanted = views.table(spark, sf, "customer").select(
        F.concat(F.lit("INC-"), F.col("c_custkey").cast("string"), F.lit("-2024-01-05")).alias("incident_group")
    )
    return anomaly.incident_anomaly_for(wanted, scored(spark, sf))


@query(
    "q_a8_category_by_source",
    EVENT
    + """SELECT category, count(*) FILTER (source_type = 'alert') AS alert,
 count(*) FILTER (source_type = 'ticket') AS ticket, count(*) FILTER (source_type = 'log') AS log
 FROM event_signals GROUP BY 1""",
)
def a8(spark, sf):
    return reports.category_by_source(events(spark, sf))


@query(
    "q_a9_value_counts",
    EVENT
    + """SELECT 'category' AS field, category AS value, count(*) AS n FROM event_signals GROUP BY 2
 UNION ALL SELECT 'source_type', source_type, count(*) FROM event_signals GROUP BY 2""",
)
def a9(spark, sf):
    return reports.value_counts(events(spark, sf), ["category", "source_type"])


@query(
    "q_a10_distinct_counts",
    EVENT
    + """SELECT count(*) AS signals, count(DISTINCT incident_group) AS incidents,
 count(DISTINCT category) AS categories FROM event_signals""",
)
def a10(spark, sf):
    return reports.distinct_counts(events(spark, sf))


@query(
    "q_a11_distinct_list",
    EVENT
    + """SELECT category, string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS source_types
 FROM event_signals GROUP BY 1""",
)
def a11(spark, sf):
    return (
        events(spark, sf)
        .groupBy("category")
        .agg(F.array_join(reports.closed_set("source_type"), ",").alias("source_types"))
    )


@query(
    "q_a12_mode",
    EVENT
    + """SELECT incident_group, category FROM (SELECT *, row_number() OVER (PARTITION BY incident_group
 ORDER BY n DESC, first) AS r FROM (SELECT incident_group, category, count(*) AS n, min(signal_id) AS first
 FROM event_signals GROUP BY 1, 2)) WHERE r = 1""",
)
def a12(spark, sf):
    return reports.mode_per_group(events(spark, sf), "incident_group", "category")


@query(
    "q_a16_dataset_statistics",
    EVENT
    + """SELECT 'total_signals' AS metric, '' AS item, count(*) AS value FROM event_signals
 UNION ALL SELECT 'categories', '', count(DISTINCT category) FROM event_signals
 UNION ALL SELECT 'source_types', '', count(DISTINCT source_type) FROM event_signals
 UNION ALL SELECT 'category_distribution', category, count(*) FROM event_signals GROUP BY 2
 UNION ALL SELECT 'source_distribution', source_type, count(*) FROM event_signals GROUP BY 2""",
)
def a16(spark, sf):
    return reports.dataset_statistics(events(spark, sf))


@query(
    "q_r1_global_rank",
    EVENT_SCORED
    + """SELECT signal_id, row_number() OVER (ORDER BY anomaly_score DESC, timestamp, signal_id) AS rank
 FROM scored""",
)
def r1(spark, sf):
    ranked = ranking.global_rank(
        scored(spark, sf).select("signal_id", "anomaly_score", "timestamp"),
        [F.desc("anomaly_score"), F.asc("timestamp"), F.asc("signal_id")],
    )
    return ranked.select("signal_id", "rank")


@query(
    "q_r2_top_n",
    EVENT_SCORED
    + """SELECT signal_id, hour, time_context, z_score, anomaly_score, is_anomalous FROM scored
 ORDER BY anomaly_score DESC, signal_id LIMIT 5""",
)
def r2(spark, sf):
    return reports.most_anomalous(scored(spark, sf), 5)


@query(
    "q_r3_first_per_group",
    EVENT_SCORED
    + """SELECT time_context, timestamp, signal_id, anomaly_score FROM (SELECT *, row_number() OVER
 (PARTITION BY time_context ORDER BY timestamp, signal_id) AS r FROM scored) WHERE r = 1""",
)
def r3(spark, sf):
    narrow = scored(spark, sf).select("time_context", "timestamp", "signal_id", "anomaly_score")
    return ranking.first_per_group(narrow, ["time_context"], ["timestamp", "signal_id"])


@query(
    "q_r4_aggregate_to_rows",
    EVENT_SCORED
    + f"""SELECT signal_id, {C.rnd('anomaly_score - m')} AS above_mean FROM scored, (SELECT
 CAST(sum({C.units('anomaly_score')}) AS DOUBLE) / count(*) / 10000::DOUBLE AS m FROM scored)""",
)
def r4(spark, sf):
    df = scored(spark, sf)
    return reports.above_mean(df, "anomaly_score").select("signal_id", "above_mean")


@query(
    "q_r5_chronological",
    EVENT + "SELECT signal_id, timestamp FROM event_signals ORDER BY timestamp, signal_id",
)
def r5(spark, sf):
    return events(spark, sf).select("signal_id", "timestamp").orderBy("timestamp", "signal_id")


@query(
    "q_r7_max_by_metric",
    EVENT_SCORED
    + f"""SELECT category, m AS mean_score, rank() OVER (ORDER BY m DESC) = 1 AS best FROM (SELECT category,
 {C.rnd(f"CAST(sum({C.units('anomaly_score')}) AS DOUBLE) / count(*) / 10000::DOUBLE")} AS m
 FROM scored GROUP BY 1)""",
)
def r7(spark, sf):
    return reports.best_category(scored(spark, sf))


@query(
    "q_u1_set_difference",
    C.with_(C.EVENT, DIRTY)
    + "SELECT DISTINCT source_type AS value FROM dirty EXCEPT SELECT DISTINCT source_type FROM event_signals",
)
def u1(spark, sf):
    return reports.only_left(dirty(spark, sf), events(spark, sf), "source_type")


@query(
    "q_u2_set_intersection",
    C.with_(C.EVENT, DIRTY)
    + "SELECT DISTINCT category AS value FROM dirty INTERSECT SELECT DISTINCT category FROM event_signals",
)
def u2(spark, sf):
    return reports.in_both(dirty(spark, sf), events(spark, sf), "category")


@query(
    "q_u3_union_all",
    C.with_(C.EVENT, DIRTY)
    + """SELECT signal_id, category, 'clean' AS origin FROM event_signals
 UNION ALL SELECT signal_id, category, 'faulty' FROM dirty""",
)
def u3(spark, sf):
    def tagged(df, origin):
        return df.select("signal_id", "category", F.lit(origin).alias("origin"))

    return tagged(events(spark, sf), "clean").unionByName(tagged(dirty(spark, sf), "faulty"))


@query(
    "q_j1_lookup_join",
    C.with_(C.EVENT, C.predictions("event_signals"))
    + """SELECT p.signal_id, p.predicted_category, e.source_type, e.timestamp
 FROM predictions p JOIN event_signals e ON p.signal_id = e.signal_id""",
)
def j1(spark, sf):
    df = events(spark, sf)
    return (
        views.predictions(df)
        .join(df.select("signal_id", "source_type", "timestamp"), "signal_id")
        .select("signal_id", "predicted_category", "source_type", "timestamp")
    )


@query(
    "q_j3_score_merge_back",
    EVENT_SCORED + "SELECT signal_id, category, z_score, anomaly_score, is_anomalous, time_context FROM scored",
)
def j3(spark, sf):
    return scored(spark, sf).select(
        "signal_id", "category", "z_score", "anomaly_score", "is_anomalous", "time_context"
    )


@query(
    "q_j8_hour_baseline_join",
    EVENT_SCORED
    + f"""SELECT t.signal_id, b.count, {C.rnd('b.mean', 6)} AS mean, {C.rnd('b.std', 6)} AS std
 FROM timed t JOIN baseline b ON t.hour = b.hour""",
)
def j8(spark, sf):
    df = timed(spark, sf)
    return rounded(df.join(F.broadcast(anomaly.hourly_baseline(df)), "hour")).select(
        "signal_id", "count", "mean", "std"
    )


@query(
    "q_m1_label_index",
    EVENT
    + f"""SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS label
 FROM (SELECT unnest([{C.CATEGORY_LIST}]) AS category)
 WHERE category IN (SELECT DISTINCT category FROM event_signals)""",
)
def m1(spark, sf):
    from opsignal.operators.classify import label_index

    return (
        events(spark, sf)
        .select("category")
        .distinct()
        .withColumn("label", label_index(F.col("category")))
    )


@query(
    "q_m2_stratified_split",
    EVENT
    + """SELECT signal_id, category, r <= k AS is_test FROM (SELECT signal_id, category,
 row_number() OVER (PARTITION BY category ORDER BY md5(signal_id), signal_id) AS r,
 CAST(round(CAST(0.2 AS DECIMAL(9,6)) * count(*) OVER (PARTITION BY category), 0) AS BIGINT) AS k
 FROM event_signals)""",
)
def m2(spark, sf):
    return ranking.stratified_split(events(spark, sf), "category", 0.2).select(
        "signal_id", "category", "is_test"
    )


@query(
    "q_c9_row_confidence",
    C.with_(C.EVENT, TIMED, *scored_ctes("timed"), C.predictions("event_signals"))
    + f"""SELECT s.signal_id, least(1.0, {C.rnd(
      "s.source_weight * 0.3 + p.confidence * 0.4 + least(1.0 + s.anomaly_score, 2.0) * 0.3 * 0.5")})
 AS confidence_score FROM scored s JOIN predictions p ON s.signal_id = p.signal_id""",
)
def c9(spark, sf):
    from opsignal.functions.scoring import confidence

    df = scored(spark, sf)
    pred = views.predictions(events(spark, sf)).select("signal_id", "confidence")
    return df.join(pred, "signal_id").select(
        "signal_id",
        confidence(F.col("source_weight"), F.col("confidence"), F.col("anomaly_score")).alias("confidence_score"),
    )


@query(
    "q_m8_expected_vs_predicted",
    C.with_(C.EVENT, C.predictions("event_signals"))
    + """SELECT e.signal_id, e.category, p.predicted_category, e.category = p.predicted_category AS correct
 FROM event_signals e JOIN predictions p ON e.signal_id = p.signal_id""",
)
def m8(spark, sf):
    df = events(spark, sf)
    pred = views.predictions(df).select("signal_id", "predicted_category")
    return df.join(pred, "signal_id").select(
        "signal_id",
        "category",
        "predicted_category",
        (F.col("category") == F.col("predicted_category")).alias("correct"),
    )


@query(
    "q_n13_before_after_sample",
    EVENT
    + """SELECT source_type, timestamp, signal_id, text FROM (SELECT *, row_number() OVER
 (PARTITION BY source_type ORDER BY timestamp, signal_id) AS r FROM event_signals) WHERE r = 1""",
)
def n13(spark, sf):
    return preprocess.before_after_sample(preprocess.normalise_signals(events(spark, sf))).drop(
        "normalised_text"
    )
