"""Scores of all pairs of the chosen incidents."""

import random

import pytest

from opsignal.operators import pairstats
from test_sparse_join import plain


@pytest.mark.parametrize("block_rows", (4, 1024))
def test_every_pair_is_scored_and_the_first_that_share_a_term_are_shown(spark, monkeypatch, block_rows):
    monkeypatch.setattr(pairstats.all_scores, "__defaults__", (block_rows,))
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(5))) for _ in range(30)]
    rows = [(f"s{i:02}", f"F{rng.randrange(9)}", "INC" if not t else t) for i, t in enumerate(texts)] + [("s99", "G", "w1")]
    df = spark.createDataFrame(rows, "signal_id string, incident_group string, preprocessed_text string").repartition(3)
    focus = rows[:-1]
    score = plain([r[2] for r in focus], 1e-12)
    every = [(i, j) for i in range(len(focus)) for j in range(i + 1, len(focus))]
    same = [p for p in every if focus[p[0]][1] == focus[p[1]][1]]
    other = [p for p in every if p not in same and p in score][:6]
    assert other != [p for p in every if p not in same][:6]
    want = [(focus[i][0], focus[j][0], round(score.get((i, j), 0.0), 3), (i, j) in same) for i, j in same + other]
    got = pairstats.focus_pairs(df, ["F"], sharing=True).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_the_check_sql_scores_all_pairs():
    from opsignal.plans import catalogue

    assert "fs AS (SELECT a.signal_id AS signal_a" in catalogue.SQL["q_j16_focus_comparison"]
