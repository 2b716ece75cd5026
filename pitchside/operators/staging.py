"""Staging layer (P1-P8): renames, scope filters and the match outcome rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.config import RankingSnapshot
from pitchside.functions.columns import round_half_away

_MATCH_RENAMES: tuple[tuple[str, str], ...] = (
    ("Year", "year"),
    ("Date", "match_date"),
    ("Host", "host"),
    ("Round", "round"),
    ("Venue", "venue"),
    ("Attendance", "attendance"),
    ("home_team", "home_team"),
    ("away_team", "away_team"),
    ("home_score", "home_score"),
    ("away_score", "away_score"),
    ("home_xg", "home_xg"),
    ("away_xg", "away_xg"),
    ("home_penalty", "home_pens"),
    ("away_penalty", "away_pens"),
    ("home_manager", "home_manager"),
    ("away_manager", "away_manager"),
    ("home_captain", "home_captain"),
    ("away_captain", "away_captain"),
    ("Referee", "referee"),
    ("Notes", "notes"),
)


def scope(df: DataFrame, years: Iterable[int] | None, column: str = "year") -> DataFrame:
    """Keep the editions in scope; ``None`` keeps all."""
    if years is None:
        return df
    return df.where(F.col(column).isin([int(y) for y in years]))


def match_base(raw_matches: DataFrame, years: Iterable[int] | None) -> DataFrame:
    """snake_case names and the scope filter (pushed into the scan by Catalyst)."""
    renamed = raw_matches.select(*[F.col(f"`{src}`").alias(dst) for src, dst in _MATCH_RENAMES])
    return scope(renamed, years)


def with_match_outcomes(base: DataFrame) -> DataFrame:
    """P2-P6 on a match-grain frame with home/away scores, pens and xG."""
    hs, as_ = F.col("home_score"), F.col("away_score")
    hp, ap = F.coalesce(F.col("home_pens"), F.lit(0)), F.coalesce(F.col("away_pens"), F.lit(0))
    return base.select(
        "*",
        # NULL when a score is NULL
        (hs + as_).alias("total_goals"),
        (hs - as_).alias("home_goal_diff"),
        # 0 and NULL both mean "no shoot-out"; never NULL
        ((hp + ap) > 0).alias("decided_on_pens"),
        # A NULL score falls through to 'draw'
        F.when(hs > as_, "home_win").when(hs < as_, "away_win").otherwise("draw").alias("result_regulation"),
        # P5: score first, then shoot-out, else NULL (a true draw)
        F.when(hs > as_, F.col("home_team"))
        .when(as_ > hs, F.col("away_team"))
        .when(hp > ap, F.col("home_team"))
        .when(ap > hp, F.col("away_team"))
        .alias("winner"),
        # Only when both xG are present
        F.when(
            F.col("home_xg").isNotNull() & F.col("away_xg").isNotNull(),
            round_half_away((hs + as_) - (F.col("home_xg") + F.col("away_xg")), 2),
        ).alias("goals_minus_xg"),
    )


def stg_matches(raw_matches: DataFrame, years: Iterable[int] | None) -> DataFrame:
    """stg.matches = P1 + P2..P6."""
    return with_match_outcomes(match_base(raw_matches, years))


def stg_world_cup(raw_world_cup: DataFrame, years: Iterable[int] | None) -> DataFrame:
    """One row per edition in scope, renamed."""
    renamed = raw_world_cup.select(
        F.col("Year").alias("year"),
        F.col("Host").alias("host"),
        F.col("Teams").alias("n_teams"),
        F.col("Champion").alias("champion"),
        F.col("`Runner-Up`").alias("runner_up"),
        F.col("TopScorrer").alias("top_scorer"),
        F.col("Attendance").alias("attendance_total"),
        F.col("AttendanceAvg").alias("attendance_avg"),
        F.col("Matches").alias("n_matches"),
    )
    return scope(renamed, years)


_RANKING_COLS = ("team", "team_code", "association", "rank", "previous_rank", "points", "previous_points")


def stg_rankings(snapshots: Sequence[tuple[DataFrame, RankingSnapshot]]) -> DataFrame:
    """Ranking snapshots in long format with their date and cycle.

    Works for any number of snapshots; a snapshot without ``rated_matches``
    gets a typed NULL there."""
    parts = []
    for df, snap in snapshots:
        rated = F.col("rated_matches") if snap.has_rated_matches else F.lit(None).cast("bigint")
        parts.append(
            df.select(
                F.lit(snap.snapshot_date).alias("snapshot_date"),
                F.lit(snap.cycle).alias("cycle"),
                *_RANKING_COLS,
                rated.cast("bigint").alias("rated_matches"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
