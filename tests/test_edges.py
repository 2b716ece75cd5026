"""NULL-edge rules of the outcome and favourite columns (own six-row fixture)."""

from __future__ import annotations

import datetime as dt

from pitchside.operators import marts, staging
from pitchside.sources.schemas import MATCHES

# id, home_score, away_score, home_pen, away_pen, home_rank, away_rank
CASES = [
    (1, None, 1, None, None, 5, 5),
    (2, 1, 1, None, None, 1, 2),
    (3, 1, 1, 3, 4, 1, 2),
    (4, 0, 0, 0, 0, None, 2),
    (5, 2, 1, None, None, None, 2),
    (6, 2, 1, None, None, 3, 3),
]
# id -> result, winner, on_pens, higher_ranked, favorite_won
EXPECTED = {
    1: ("draw", None, False, "A1", None),
    2: ("draw", None, False, "H2", None),
    3: ("draw", "A3", True, "H3", False),
    4: ("draw", None, False, "A4", None),
    5: ("home_win", "H5", False, "A5", False),
    6: ("home_win", "H6", False, "A6", False),
}


def _raw(spark):
    rows = []
    for i, hs, as_, hp, ap, _, _ in CASES:
        rows.append((2000, dt.date(2000, 6, i), "H", "Group stage", "V", 1, f"H{i}", f"A{i}", hs, as_, None, None,
                     hp, ap, None, None, None, None, None, None))
    return spark.createDataFrame(rows, MATCHES)


def test_outcome_columns(spark):
    stg = staging.stg_matches(_raw(spark), [2000])
    got = {r["home_team"]: r for r in stg.collect()}
    for i, (res, win, pens, _, _) in EXPECTED.items():
        r = got[f"H{i}"]
        assert (r["result_regulation"], r["winner"], r["decided_on_pens"]) == (res, win, pens), i


def test_favourite_columns(spark):
    stg = staging.stg_matches(_raw(spark), [2000])
    ranks = spark.createDataFrame(
        [(t, r) for i, _, _, _, _, hr, ar in CASES for t, r in ((f"H{i}", hr), (f"A{i}", ar)) if r is not None],
        "team string, rank long",
    )
    cw = spark.createDataFrame([], "match_name string, ranking_name string")
    out = marts.with_side_ranks(stg, cw, ranks).select(
        "home_team",
        marts.higher_ranked(ranks_col("home_rank"), ranks_col("away_rank")).alias("higher_ranked"),
        marts.favorite_won(ranks_col("home_rank"), ranks_col("away_rank")).alias("favorite_won"),
    )
    got = {r["home_team"]: r for r in out.collect()}
    for i, (_, _, _, hr, fw) in EXPECTED.items():
        assert (got[f"H{i}"]["higher_ranked"], got[f"H{i}"]["favorite_won"]) == (hr, fw), i


def ranks_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_team_perspective_won_match_null_on_draw(spark):
    stg = staging.stg_matches(_raw(spark), [2000])
    itm = marts.int_team_matches(stg)
    assert itm.count() == 12
    draws = {r["team"]: r["won_match"] for r in itm.collect() if r["team"] in ("H2", "A2")}
    assert draws == {"H2": None, "A2": None}


def test_missing_probabilities_give_no_label_and_no_loss(spark):
    from pyspark.sql import functions as F

    from pitchside.functions import columns as C

    rows = [(0.2, 0.5, 0.3), (None, 0.5, 0.5), (0.5, None, 0.5), (0.5, 0.5, None), (None, None, None), (0.4, 0.3, 0.3), (0.0, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "h double, d double, a double")
    got = df.select(C.argmax_label(F.col("h"), F.col("d"), F.col("a")), C.log_loss_term(F.col("h"))).collect()
    assert [r[0] for r in got] == ["draw", None, None, None, None, "home_win", "draw"]
    assert [r[1] is None for r in got] == [False, True, False, False, True, False, False]


def test_a_team_without_history_and_points_fails_by_name(spark):
    import pytest

    from pitchside.operators import model

    stats = spark.createDataFrame([("Old", 3.0, 4.0, 2.0, 4.0, 2.0), ("Older", 3.0, 2.0, 4.0, 2.0, 4.0)], "team string, matches double, goals_for double, goals_against double, xg_for double, xg_against double")
    rankings = spark.createDataFrame([("Old", 1, 1500.0), ("Older", 2, 1200.0), ("Nobody", None, None)], "team string, rank long, points double")
    sm = model.StrengthModel(stats, rankings, model.default_grid())
    pairs = lambda *p: spark.createDataFrame(p, "home_team string, away_team string")
    assert sm.score(pairs(("Old", "Older"))).first()["prob_home_win"] > 0.4
    for bad in (("Old", "Nobody"), ("Unheard", "Older")):
        with pytest.raises(Exception, match="no strength for team: (Nobody|Unheard)"):
            sm.score(pairs(("Old", "Older"), bad)).collect()
