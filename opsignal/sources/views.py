"""Signal tables derived from the driver's parquet tables.

Each view is one SQL text that Spark and a SQL checker read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_CATEGORY = """CASE event_type WHEN 'error' THEN 'Authentication Failure'
  WHEN 'view' THEN 'Network Outage' WHEN 'signup' THEN 'Deployment Failure'
  WHEN 'click' THEN 'Performance Degradation' ELSE 'Security Breach' END"""

EVENT_SIGNALS = f"""
SELECT concat('EVT-', lpad(CAST(event_id AS STRING), 8, '0')) AS signal_id,
 CASE event_id % 3 WHEN 0 THEN 'alert' WHEN 1 THEN 'ticket' ELSE 'log' END AS source_type,
 {_CATEGORY} AS category,
 concat(CASE event_id % 3 WHEN 0 THEN 'CRITICAL: ' WHEN 1 THEN 'WARN ' ELSE '' END, event_type,
  ' rate ', CAST(event_id % 100 AS STRING), '% at ', lpad(CAST(hour(ts) AS STRING),2,'0'), ':',
  lpad(CAST(minute(ts) AS STRING),2,'0'), ' host 10.0.', CAST(user_id % 256 AS STRING), '.',
  CAST(event_id % 256 AS STRING), ' v1.', CAST(user_id % 10 AS STRING),
  ' code ', CAST(400 + event_id % 200 AS STRING), ' users failed') AS text,
 ts AS timestamp,
 concat('INC-', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS incident_group
FROM events"""

DOC_SIGNALS = f"""
SELECT concat('DOC-', lpad(CAST(doc_id AS STRING), 8, '0')) AS signal_id,
 CASE doc_id % 3 WHEN 0 THEN 'alert' WHEN 1 THEN 'ticket' ELSE 'log' END AS source_type,
 {_CATEGORY} AS category,
 text, ts AS timestamp,
 concat('INC-', lpad(CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING), 8, '0')) AS incident_group
FROM documents JOIN events ON doc_id = event_id"""

VECTOR_SIGNALS = f"""
SELECT concat('VEC-', lpad(CAST(vec_id AS STRING), 8, '0')) AS signal_id,
 CASE vec_id % 3 WHEN 0 THEN 'alert' WHEN 1 THEN 'ticket' ELSE 'log' END AS source_type,
 {_CATEGORY} AS category,
 embedding, ts AS timestamp,
 concat('INC-', CAST(label AS STRING)) AS incident_group
FROM embeddings JOIN events ON vec_id = event_id"""

_PREDICTED = """CASE WHEN substr(md5(signal_id),1,1) < 'd' THEN category ELSE 'Network Outage' END
  AS predicted_category,
 0.5 + CAST(ascii(substr(md5(signal_id),2,1)) % 50 AS DOUBLE) / 100 AS confidence"""
PREDICTIONS = f"""
SELECT signal_id,
 {_PREDICTED}
FROM {{signals}}"""

_VIEWS = {
    "event_signals": EVENT_SIGNALS,
    "doc_signals": DOC_SIGNALS,
    "vector_signals": VECTOR_SIGNALS,
}
_INPUTS = {
    "event_signals": ("events",),
    "doc_signals": ("documents", "events"),
    "vector_signals": ("embeddings", "events"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores, so that text work uses all of them.

    Large inputs have splits enough and are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return _dealt(df, cores) if df.rdd.getNumPartitions() < cores else df


#: Short rows that a task begins with, on average.
ROWS_PER_TASK = 1 << 18


def spread_rows(df: DataFrame) -> DataFrame:
    """Spread short rows over all cores and into parts of a bounded size.

    A file of short rows may be a single row group, which one split reads whole however many splits
    there are, and a text made of a row is far longer than the row.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return _dealt(df, max(cores, -(-df.count() // ROWS_PER_TASK)))


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    # By hash: dealing rows in turn sorts them first, a whole split in one task.
    return df.repartition(parts, F.xxhash64(*df.columns))


def signals(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """``event_signals``, ``doc_signals`` or ``vector_signals`` with UTC timestamps."""
    inputs = {name: table(spark, sf_dir, name) for name in _INPUTS[view]}
    if view == "event_signals":
        inputs["events"] = spread_rows(inputs["events"].select("event_id", "ts", "user_id", "event_type"))
    if "documents" in inputs:
        inputs["documents"] = spread(inputs["documents"].select("doc_id", "text"))
    text = _VIEWS[view]
    for name in inputs:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    df = spark.sql(text, **inputs)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def event_stream(events: DataFrame) -> DataFrame:
    """The event signals over a stream of the ``events`` table."""
    df = events.sparkSession.sql(EVENT_SIGNALS.replace("FROM events", "FROM {events}"), events=events)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def predictions(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for a trained classifier's output."""
    return df.sparkSession.sql(PREDICTIONS, signals=df)


def with_predictions(df: DataFrame) -> DataFrame:
    """``df`` with the columns of ``predictions`` beside its own."""
    return df.sparkSession.sql(f"SELECT *, {_PREDICTED} FROM {{signals}}", signals=df)
