"""Streams that are run in parts, and what they keep between the parts."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from opsignal.operators import anomaly, timewindow
from opsignal.session import new_path
from opsignal.sources import signals as store
from opsignal.streaming import edges, score

SCHEMA = "signal_id string, category string, timestamp timestamp"
START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def made(seed=1, hours=12, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + datetime.timedelta(microseconds=rng.choice([rng.randrange(hours * 3_600_000_000), rng.randrange(hours * 2) * 1_800_000_000]))
        rows.append((f"s{i}", rng.choice(["a", "b", None]), at))
    return sorted(rows, key=lambda r: r[2])


def counted(rows, upto):
    """Edges by looking at every pair; those whose later bucket ends by ``upto``."""
    out = {}
    for i, (_, a, s) in enumerate(rows):
        for _, b, t in rows[i + 1 :]:
            if a and a == b and (t - s).total_seconds() <= 1800:
                early, late = (START + (x - START) // datetime.timedelta(minutes=30) * datetime.timedelta(minutes=30) for x in (s, t))
                if late + datetime.timedelta(minutes=30) <= upto:
                    out[a, early, late] = out.get((a, early, late), 0) + 1
    return out


def seen(df):
    rows = df.withColumns({c: F.unix_micros(c) for c in ("early_start", "late_start")}).collect()
    at = lambda us: START + datetime.timedelta(microseconds=us - int(START.timestamp() * 1_000_000))
    out = {(r["category"], at(r["early_start"]), at(r["late_start"])): int(r["pairs"]) for r in rows}
    assert len(out) == len(rows)  # every edge once
    return out


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def test_edges_of_two_runs_equal_those_of_one(spark):
    rows = made()
    parts = new_path(spark, "parts"), new_path(spark, "whole")
    result = new_path(spark, "kept"), new_path(spark, "kept")
    for part in (rows[:130], rows[130:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(parts[0])
        in_parts = score.to_table(edges.edge_stream(stream(spark, parts[0])), "edges", result[0])
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(parts[1])
    at_once = score.to_table(edges.edge_stream(stream(spark, parts[1])), "edges", result[1])
    want = counted(rows, rows[-1][2] - datetime.timedelta(minutes=30))
    assert seen(at_once) == want and seen(in_parts) == want
    again = score.to_table(edges.edge_stream(stream(spark, parts[1])), "edges", result[1])
    assert seen(again) == want  # nothing new arrived


def test_state_is_bounded_by_the_window(spark):
    left = []
    for hours in (12, 48):
        folder, kept = new_path(spark, "input"), new_path(spark, "kept")
        spark.createDataFrame(made(2, hours, 25 * hours), SCHEMA).coalesce(1).write.parquet(folder)
        run = (
            edges.edge_stream(stream(spark, folder)).writeStream.format("parquet").option("path", f"{kept}/rows")
            .option("checkpointLocation", f"{kept}/progress").trigger(availableNow=True).start()
        )
        run.awaitTermination()
        left.append(sum(s.numRowsTotal for s in run.lastProgress.stateOperators))
    # four digits of the signals of the last two buckets and the delay, on two sides and in the join
    assert max(left) < 25 * 2 * 4 * 3


def test_baseline_of_two_runs_equals_the_batch_one(spark):
    rows = made(6, 40)
    folder, kept = new_path(spark, "input"), new_path(spark, "kept")
    for part in (rows[:140], rows[140:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        found = score.stream_baseline(stream(spark, folder), kept)
    final = rows[-1][2] - datetime.timedelta(minutes=30)
    past = [r for r in rows if r[2].replace(minute=0, second=0, microsecond=0) + datetime.timedelta(hours=1) <= final]
    batch = anomaly.hourly_baseline(spark.createDataFrame(past, SCHEMA).withColumn("hour", F.hour("timestamp")))
    assert len(past) < len(rows) and sorted(found.collect()) == sorted(batch.collect())


def test_batch_edges_equal_a_plain_count(spark):
    rows = made(3)
    found = timewindow.cell_edges(spark.createDataFrame(rows, SCHEMA), ["category"])
    start = {c: F.timestamp_micros(F.col(c) * 1_800_000_000) for c in ("early", "late")}
    found = found.withColumns({"early_start": start["early"], "late_start": start["late"]})
    assert seen(found) == counted(rows, rows[-1][2] + datetime.timedelta(days=1))


def test_a_stream_without_data_gives_an_empty_table(spark):
    folder = new_path(spark, "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    for name in os.listdir(folder.removeprefix("file:")):
        if name.startswith("part"):
            os.remove(f"{folder.removeprefix('file:')}/{name}")
    assert score.to_table(stream(spark, folder), "nothing").collect() == []
    assert score.each_batch(stream(spark, folder), "nothing", lambda b: b, SCHEMA).collect() == []


def test_path_with_a_trailing_slash(spark):
    folder = new_path(spark, "slash")
    spark.createDataFrame(made(4)[:5], SCHEMA).write.parquet(folder)
    assert score.to_table(score.read_stream(spark, f"{folder}/", spark.read.parquet(folder).schema), "slash").count() == 5


def test_first_existing_passes_on_other_errors(spark):
    there = store.write_signals(spark.createDataFrame(made(5)[:3], SCHEMA), new_path(spark, "there"))
    assert store.first_existing(spark, [new_path(spark, "absent"), there]).count() == 3
    with pytest.raises(FileNotFoundError):
        store.first_existing(spark, [new_path(spark, "absent")])
    empty = new_path(spark, "hollow")
    os.makedirs(empty.removeprefix("file:"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        store.first_existing(spark, [empty, there])
