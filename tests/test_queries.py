"""A sample of registered queries against their check SQL on the smallest tables."""

import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, table_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "q_a4_score_all_signals", "q_n11_normalise_long_text", "q_k7_preprocess_signals", "q_m2_stratified_split",
    "q_j7_time_window_pairs", "q_c10_correlate_signals", "q_j5_sparse_cosine_join", "q_e4_similarity_evaluation",
    "q_x4_stream_anomaly", "q_x6_windowed_pairing",
)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of(rel.columns, rel.fetchall())


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 130
