"""Business questions (Q1-Q5), diagnostics (D1-D2) and EDA tables.

Top-k questions add tie-breakers (team, year) that the reference leaves
out, so the result is deterministic; ``orderBy(...).limit(k)`` plans as a
per-partition top-k followed by a merge (no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import rate_pct
from pitchside.plans.layers import Warehouse


def q1_edition_kpis(wh: Warehouse) -> DataFrame:
    """Did the tournament change between editions?"""
    return wh.edition_kpis.orderBy("year")


def q2_top_attack(wh: Warehouse, min_matches: int = config.MIN_MATCHES_TOP, k: int = 8) -> DataFrame:
    """Who finished above expectation (T1 over A3 with P16)."""
    return (
        wh.team_performance.where(F.col("matches") >= min_matches)
        .select("team", "year", "matches", "goals_for", "xg_for", "attack_vs_xg")
        .orderBy(F.col("attack_vs_xg").desc(), "team", "year")
        .limit(k)
    )


def q3_top_defense(wh: Warehouse, min_matches: int = config.MIN_MATCHES_TOP, k: int = 8) -> DataFrame:
    """Which defenses beat expectation."""
    return (
        wh.team_performance.where(F.col("matches") >= min_matches)
        .select("team", "year", "matches", "goals_against", "xg_against", "defense_vs_xg")
        .orderBy(F.col("defense_vs_xg").desc(), "team", "year")
        .limit(k)
    )


def q4_knockout(wh: Warehouse) -> DataFrame:
    """Does the knockout stage tighten (T4 over A2)?"""
    return wh.knockout_analysis.orderBy("year", "stage_order").select(
        "year", "round", "n_matches", "goals_per_match", "xg_per_match", "pen_shootouts"
    )


def favorite_rate(df: DataFrame, *keys, extra=()) -> DataFrame:
    """Decided matches, favourite wins and their share per group
    (the share is NULL, not an error, when nothing was decided)."""
    fw = F.col("favorite_won")
    decided = F.count_if(fw.isNotNull())
    wins = F.count_if(fw)
    return df.groupBy(*keys).agg(
        decided.alias("decided"),
        wins.alias("favorite_won"),
        rate_pct(wins, decided, 1).alias("favorite_win_pct"),
        *extra,
    )


def q5_favorite_by_phase(wh: Warehouse, group_label: str = "Group stage", knockout_label: str = "Knockout") -> DataFrame:
    """Did the ranking predict results? Hit rate of the favourite by phase."""
    phase = F.when(F.col("round") == config.GROUP_STAGE, F.lit(group_label)).otherwise(F.lit(knockout_label))
    return favorite_rate(wh.ranking_vs_result.withColumn("phase", phase), "phase").orderBy("phase")


def d1_round_frequency(wh: Warehouse) -> DataFrame:
    """Distinct rounds, in order of first appearance."""
    return (
        wh.stg_matches.groupBy("round")
        .agg(F.count(F.lit(1)).alias("n"), F.min("match_date").alias("_first"))
        .orderBy("_first", "round")
        .drop("_first")
    )


def d2_unranked_teams(wh: Warehouse) -> DataFrame:
    """Teams of the test edition with no ranking row under their own name
    (U6; raw names, before the crosswalk, which is what reveals the need for it)."""
    played = wh.int_team_matches.where(F.col("year") == wh.scope.test_year).select("team")
    ranked = wh.stg_rankings.where(F.col("cycle") == wh.scope.test_cycle).select("team")
    return played.subtract(ranked).orderBy("team")


def e1_team_performance(wh: Warehouse) -> DataFrame:
    """Team performance, EDA column set."""
    return wh.team_performance.select(
        "team", "year", "matches", "goals_for", "goals_against", "goal_diff",
        "xg_for", "xg_against", "attack_vs_xg", "defense_vs_xg",
    )


def e2_efficiency_table(wh: Warehouse, min_matches: int = config.MIN_MATCHES_TABLE) -> DataFrame:
    """Efficiency table (T3): sorted by attack + defense against xG."""
    return (
        wh.team_performance.where(F.col("matches") >= min_matches)
        .select("team", "year", "matches", "goals_for", "xg_for", "attack_vs_xg",
                "goals_against", "xg_against", "defense_vs_xg")
        .orderBy((F.col("attack_vs_xg") + F.col("defense_vs_xg")).desc(), "team", "year")
    )
