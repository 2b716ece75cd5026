"""Predictions for the future schedule, as one lazy plan.

Strength is trained on the pooled editions in scope, teams without history
get the ranking-points fallback, and every fixture is scored on a neutral
venue. Sinks (CSV and table) are in :mod:`pitchside.sources.sinks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import round_half_away
from pitchside.operators import model
from pitchside.plans.layers import Warehouse
from pitchside.sources import store

PREDICTION_COLUMNS = (
    "round", "date", "home_team", "away_team",
    "expected_home_goals", "expected_away_goals",
    "prob_home_win", "prob_draw", "prob_away_win",
)


def prediction_model(wh: Warehouse, grid: model.Grid | None = None) -> model.StrengthModel:
    # one row per team, written once: the model's branches read a tiny file
    stats = store.materialize(model.team_stats(wh.int_team_matches, None, wh.team_strength_inputs), "team_stats")
    rankings = model.team_rankings(
        model.schedule_teams(wh.raw.schedule), wh.crosswalk, wh.stg_rankings, wh.scope.predict_cycle
    )
    return model.StrengthModel(stats, rankings, grid or model.default_grid())


def schedule(wh: Warehouse) -> DataFrame:
    return wh.raw.schedule.select(
        F.col("Round").alias("round"), F.col("Date").alias("date"), "home_team", "away_team"
    )


def predictions(
    wh: Warehouse,
    k: float = config.SHRINKAGE_K,
    w: float = config.BLEND_WEIGHT,
    max_goals: int = config.MAX_GOALS,
) -> DataFrame:
    """One row per scheduled fixture; expected goals to 3 and probabilities
    to 4 decimals, ordered by date then home team."""
    sm = prediction_model(wh, model.default_grid(k, w))
    scored = sm.score(schedule(wh), max_goals)
    return scored.select(
        "round", "date", "home_team", "away_team",
        round_half_away("mu_home", 3).alias("expected_home_goals"),
        round_half_away("mu_away", 3).alias("expected_away_goals"),
        round_half_away("prob_home_win", 4).alias("prob_home_win"),
        round_half_away("prob_draw", 4).alias("prob_draw"),
        round_half_away("prob_away_win", 4).alias("prob_away_win"),
    ).orderBy("date", "home_team", "away_team")


def probability_sum_columns() -> list[Column]:
    """A20 as aggregates, for a frame of predictions or for the tasks that write one."""
    s = F.col("prob_home_win") + F.col("prob_draw") + F.col("prob_away_win")
    return [
        F.count(F.lit(1)).alias("n_fixtures"),
        round_half_away(F.min(s), 4).alias("min_prob_sum"),
        round_half_away(F.max(s), 4).alias("max_prob_sum"),
        F.count_if(F.col("prob_home_win").isNull()).alias("unscored"),
    ]


def probability_sum_check(preds: DataFrame) -> DataFrame:
    """Min and max of the rounded probability sums (about 1.0000)."""
    return preds.agg(*probability_sum_columns())
