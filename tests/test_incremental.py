"""Incremental mart state: folds and replacements equal a full rebuild."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitchside import config
from pitchside.operators import marts, model
from pitchside.operators.incremental import MartState


def _rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def _full(matches, world_cup):
    performance = marts.team_performance(marts.int_team_matches(matches))
    return {
        "edition_kpis": marts.edition_kpis(matches, world_cup),
        "knockout_analysis": marts.knockout_analysis(marts.int_match_stages(matches)),
        "team_performance": performance,
        "team_strength_inputs": marts.team_strength_inputs(performance),
    }


def _same(state, matches, wh):
    got, expected = state.marts(wh.stg_world_cup), _full(matches, wh.stg_world_cup)
    assert {n: _rows(df) for n, df in got.items()} == {n: _rows(df) for n, df in expected.items()}
    grid = model.default_grid(config.SHRINKAGE_K, config.BLEND_WEIGHT)
    average = [model.league_average(x["team_strength_inputs"], grid).first()["league_avg"] for x in (got, expected)]
    assert average[0] == pytest.approx(average[1])


def test_folds_and_a_replaced_edition_equal_a_rebuild(spark, wh, tmp_path):
    m = wh.stg_matches
    first, second = wh.scope.years
    a, b = m.where(F.col("year") == first), m.where(F.col("year") == second)
    part = F.abs(F.xxhash64("home_team", "away_team", "match_date")) % 3
    state = MartState(spark, f"{tmp_path}/state")
    state.fold(a, "a")
    _same(state, a, wh)
    for k in range(2):  # the second edition arrives in files
        state.fold(b.where(part == k), f"b{k}")
    _same(state, a.unionByName(b.where(part < 2)), wh)
    number = state.versions.version().number
    state.fold(b.where(part == 1), "b1")  # folded before: nothing changes
    assert state.versions.version().number == number and state.batches() == {"a": [first], "b0": [second], "b1": [second]}
    state.fold(b, "b-corrected", replace=[second])
    _same(state, m, wh)
    assert state.batches() == {"a": [first], "b-corrected": [second]}
    state.fold(a.where(part == 0), "a", replace=[first])  # the same id, all of whose editions are replaced
    _same(state, a.where(part == 0).unionByName(b), wh)


def test_null_scores_and_empty_batches(spark, wh, tmp_path):
    m = wh.stg_matches.limit(40)
    holes = m.withColumns({c: F.when(F.col("home_team") < F.col("away_team"), F.col(c)) for c in ("total_goals", "home_score", "home_xg", "attendance", "host")})
    state = MartState(spark, f"{tmp_path}/state")
    state.fold(holes, "holes")
    state.fold(m.limit(0), "none")
    _same(state, holes, wh)
    state.fold(m, "whole")
    _same(state, holes.unionByName(m), wh)


def test_a_batch_of_several_editions_is_not_half_replaced_under_its_own_id(spark, wh, tmp_path):
    state = MartState(spark, f"{tmp_path}/state")
    state.fold(wh.stg_matches, "both")
    with pytest.raises(ValueError, match="both"):
        state.fold(wh.stg_matches, "both", replace=[wh.scope.years[0]])
