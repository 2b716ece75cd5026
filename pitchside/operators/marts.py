"""Mart layer: perspective unpivot, stage metadata, per-team and per-edition
aggregates, name reconciliation and the ranking-vs-result comparison.

Every aggregate here is algebraic (count, sum, avg, any_value), so Spark
runs a partial aggregate before the shuffle: a hot team or year sends one
row per map task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import round_half_away, stage_order, stage_type


def int_match_stages(stg_matches: DataFrame, stages: tuple[tuple[str, int], ...] = config.STAGE_ORDER) -> DataFrame:
    """Stage type and chronological stage order for every match."""
    return stg_matches.select(
        "*",
        stage_type("round", stages[0][0]).alias("stage_type"),
        stage_order("round", stages).alias("stage_order"),
    )


def _side(team: str, opponent: str, is_home: bool, gf: str, ga: str, xf: str, xa: str, pf: str, pa: str) -> Column:
    return F.struct(
        F.col(team).alias("team"),
        F.col(opponent).alias("opponent"),
        F.lit(is_home).alias("is_home"),
        F.col(gf).alias("goals_for"),
        F.col(ga).alias("goals_against"),
        F.col(xf).alias("xg_for"),
        F.col(xa).alias("xg_against"),
        F.col(pf).alias("pens_for"),
        F.col(pa).alias("pens_against"),
    )


def int_team_matches(stg_matches: DataFrame) -> DataFrame:
    """One row per (match, team), for/against swapped on the away side.

    One scan of the match input and a generator, instead of a UNION ALL of
    two scans."""
    home = _side("home_team", "away_team", True, "home_score", "away_score", "home_xg", "away_xg", "home_pens", "away_pens")
    away = _side("away_team", "home_team", False, "away_score", "home_score", "away_xg", "home_xg", "away_pens", "home_pens")
    sides = stg_matches.select(
        "year", "match_date", "round", "host", "decided_on_pens", "winner", F.inline(F.array(home, away))
    )
    gf, ga = F.col("goals_for"), F.col("goals_against")
    return sides.select(
        "year", "match_date", "round", "host", "team", "opponent", "is_home",
        "goals_for", "goals_against", "xg_for", "xg_against", "pens_for", "pens_against",
        "decided_on_pens",
        # Per-side regulation result; won_match is NULL when there is no winner
        F.when(gf > ga, "win").when(gf < ga, "loss").otherwise("draw").alias("result"),
        (F.col("winner") == F.col("team")).alias("won_match"),
    )


def team_sums(team_matches: DataFrame) -> DataFrame:
    """The sums behind A3 per (team, year). They can be added up: see ``incremental``."""
    return team_matches.groupBy("team", "year").agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(F.col("result") == "win").alias("wins_reg"),
        F.count_if(F.col("result") == "draw").alias("draws"),
        F.count_if(F.col("result") == "loss").alias("losses_reg"),
        F.count_if(F.col("won_match")).alias("advanced_or_won"),
        *[F.sum(c).alias(c) for c in ("goals_for", "goals_against", "xg_for", "xg_against")],
    )


def performance_of(sums: DataFrame) -> DataFrame:
    """A3 from its sums."""
    gf, ga, xf, xa = (F.col(c) for c in ("goals_for", "goals_against", "xg_for", "xg_against"))
    return sums.select(
        "team", "year", "matches", "wins_reg", "draws", "losses_reg", "advanced_or_won", "goals_for", "goals_against",
        (gf - ga).alias("goal_diff"),
        round_half_away(xf, 2).alias("xg_for"),
        round_half_away(xa, 2).alias("xg_against"),
        round_half_away(gf - xf, 2).alias("attack_vs_xg"),
        round_half_away(xa - ga, 2).alias("defense_vs_xg"),
    )


def team_performance(team_matches: DataFrame) -> DataFrame:
    """A3 (with A6 filtered counts): one row per (team, year).

    attack_vs_xg = goals - xG (positive: finished above expectation);
    defense_vs_xg = xG against - goals against (positive: conceded less than
    expected), so higher is better on both axes."""
    return performance_of(team_sums(team_matches))


def team_strength_inputs(performance: DataFrame) -> DataFrame:
    """A4: pooled per-team totals over the editions of ``performance``
    (sums of the already rounded per-edition xG)."""
    return performance.groupBy("team").agg(
        F.sum("matches").alias("matches"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        F.sum("xg_for").alias("xg_for"),
        F.sum("xg_against").alias("xg_against"),
    )


def edition_sums(stg_matches: DataFrame) -> DataFrame:
    """The sums behind A1 per (year, host): a hash aggregate over numbers."""
    xg = F.col("home_xg") + F.col("away_xg")
    return stg_matches.groupBy("year", "host").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_goals").alias("goals"), F.count("total_goals").alias("n_goals"),
        F.sum(xg).alias("xg"), F.count(xg).alias("n_xg"),
        F.count_if(F.col("decided_on_pens")).alias("pens"),
        F.sum("attendance").alias("people"), F.count("attendance").alias("n_people"),
    )


def _mean(total: str, n: str) -> Column:
    return F.col(total) / F.nullif(F.col(n), F.lit(0))


def kpis_of(per_host: DataFrame, stg_world_cup: DataFrame) -> DataFrame:
    """A1 (J1) from its sums."""
    sums = [F.sum(c).alias(c) for c in ("n", "goals", "n_goals", "xg", "n_xg", "pens", "people", "n_people")]
    years = per_host.groupBy("year").agg(F.any_value("host", True).alias("host"), *sums)
    facts = stg_world_cup.select("year", "champion", "runner_up", "top_scorer")
    return years.join(facts, "year", "left").select(
        "year", "host",
        F.col("n").alias("n_matches"),
        F.col("goals").alias("total_goals"),
        round_half_away(_mean("goals", "n_goals"), 2).alias("goals_per_match"),
        round_half_away(_mean("xg", "n_xg"), 2).alias("xg_per_match"),
        round_half_away(_mean("goals", "n_goals") - _mean("xg", "n_xg"), 2).alias("goals_minus_xg"),
        F.col("pens").alias("pen_shootouts"),
        round_half_away(_mean("people", "n_people"), 0).alias("avg_attendance"),
        "champion", "runner_up", "top_scorer",
    )


def edition_kpis(stg_matches: DataFrame, stg_world_cup: DataFrame) -> DataFrame:
    """A1 (J1): one row per edition.

    Matches are reduced per (year, host); the host (any one that is not NULL) and the
    edition's facts come to those few rows afterwards, so match rows are neither sorted nor joined."""
    return kpis_of(edition_sums(stg_matches), stg_world_cup)


def knockout_sums(match_stages: DataFrame) -> DataFrame:
    """The sums behind A2 per (year, round)."""
    xg = F.col("home_xg") + F.col("away_xg")
    return match_stages.where(F.col("stage_type") == "knockout").groupBy("year", "round").agg(
        F.max("stage_order").alias("stage_order"),  # one per round
        F.count(F.lit(1)).alias("n"),
        F.sum("total_goals").alias("goals"), F.count("total_goals").alias("n_goals"),
        F.sum(xg).alias("xg"), F.count(xg).alias("n_xg"),
        F.count_if(F.col("decided_on_pens")).alias("pens"),
    )


def knockout_of(sums: DataFrame) -> DataFrame:
    """A2 from its sums."""
    return sums.select(
        "year", "round", "stage_order",
        F.col("n").alias("n_matches"),
        round_half_away(_mean("goals", "n_goals"), 2).alias("goals_per_match"),
        round_half_away(_mean("xg", "n_xg"), 2).alias("xg_per_match"),
        F.col("pens").alias("pen_shootouts"),
    )


def knockout_analysis(match_stages: DataFrame) -> DataFrame:
    """A2: knockout rounds per edition."""
    return knockout_of(knockout_sums(match_stages))


def reconcile(df: DataFrame, name_col: str, crosswalk: DataFrame, out_col: str) -> DataFrame:
    """Ranking-side name of a team = crosswalk entry, else the name itself.

    The join strategy is left to Spark's size check; the seed loader refuses duplicate
    match names."""
    m, r = f"_{out_col}_match", f"_{out_col}_rank"
    cw = crosswalk.select(F.col("match_name").alias(m), F.col("ranking_name").alias(r))
    return (
        df.join(cw, F.col(name_col) == F.col(m), "left")
        .withColumn(out_col, F.coalesce(F.col(r), F.col(name_col)))
        .drop(m, r)
    )


def ranks_of_cycle(stg_rankings: DataFrame, cycle: int) -> DataFrame:
    return stg_rankings.where(F.col("cycle") == cycle).select("team", "rank", "points")


def with_side_ranks(matches: DataFrame, crosswalk: DataFrame, ranks: DataFrame) -> DataFrame:
    """The rank dimension joined twice, once per role (home, away)."""
    out = reconcile(matches, "home_team", crosswalk, "_home_key")
    out = reconcile(out, "away_team", crosswalk, "_away_key")
    rh = ranks.select(F.col("team").alias("_rh_team"), F.col("rank").alias("home_rank"))
    ra = ranks.select(F.col("team").alias("_ra_team"), F.col("rank").alias("away_rank"))
    return (
        out.join(rh, F.col("_home_key") == F.col("_rh_team"), "left")
        .join(ra, F.col("_away_key") == F.col("_ra_team"), "left")
        .drop("_home_key", "_away_key", "_rh_team", "_ra_team")
    )


def higher_ranked(home_rank: Column, away_rank: Column) -> Column:
    """The home side only when strictly better ranked; ties and missing ranks go to away."""
    return F.when(home_rank < away_rank, F.col("home_team")).otherwise(F.col("away_team"))


def favorite_won(home_rank: Column, away_rank: Column) -> Column:
    """NULL without a winner; TRUE if the strictly better-ranked side won."""
    w = F.col("winner")
    return (
        F.when(w.isNull(), F.lit(None).cast("boolean"))
        .when(
            ((home_rank < away_rank) & (w == F.col("home_team"))) | ((away_rank < home_rank) & (w == F.col("away_team"))),
            F.lit(True),
        )
        .otherwise(F.lit(False))
    )


def ranking_vs_result(stg_matches: DataFrame, stg_rankings: DataFrame, crosswalk: DataFrame, year: int, cycle: int) -> DataFrame:
    """mart.ranking_vs_result: did the better-ranked side win (one edition)."""
    m = stg_matches.where(F.col("year") == year).select(
        "year", "round", "home_team", "away_team", "winner", "decided_on_pens"
    )
    resolved = with_side_ranks(m, crosswalk, ranks_of_cycle(stg_rankings, cycle))
    hr, ar = F.col("home_rank"), F.col("away_rank")
    return resolved.select(
        "round", "home_team", "away_team", "home_rank", "away_rank", "winner",
        higher_ranked(hr, ar).alias("higher_ranked"),
        favorite_won(hr, ar).alias("favorite_won"),
    )
