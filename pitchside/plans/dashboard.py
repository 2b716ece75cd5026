"""Dashboard extracts (S13) and the page / EDA queries built on them
(P14-P20, A8, A10-A13, A21, U2, M17, M18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import round_half_away, stage_order
from pitchside.plans import predict as pr
from pitchside.plans.layers import Warehouse
from pitchside.plans.questions import favorite_rate
from pitchside.sources import sinks

# Fixed value: separator of the fixture label ("home × away").
FIXTURE_SEPARATOR = " × "


# ------------------------------------------------------------------ extracts


def matches_eda(wh: Warehouse) -> DataFrame:
    """Match grain with xg_total, ordered by year, stage, date; the other columns break
    ties, so the order is total and the ranges of the sort can split a busy day."""
    return wh.int_match_stages.select(
        "year", "round", "stage_type", "stage_order", "home_team", "away_team",
        "home_score", "away_score", "home_xg", "away_xg", "total_goals",
        (F.col("home_xg") + F.col("away_xg")).alias("xg_total"),
        "decided_on_pens", "winner", "match_date",
    ).orderBy(
        "year", F.col("stage_order").asc_nulls_last(), "match_date", "home_team", "away_team",
        "home_score", "away_score", "home_xg", "away_xg", "winner", "round",
    ).drop("match_date")


def matches_extract(wh: Warehouse) -> DataFrame:
    """The match extract of the dashboard (explicit column list)."""
    return wh.int_match_stages.select(
        "year", "round", "stage_type", "home_team", "away_team",
        "home_score", "away_score", "total_goals", "home_xg", "away_xg",
        (F.col("home_xg") + F.col("away_xg")).alias("xg_total"),
        "decided_on_pens", "winner",
    )


def shootouts(wh: Warehouse) -> DataFrame:
    """Matches decided on penalties, by year and stage."""
    return (
        wh.int_match_stages.where(F.col("decided_on_pens"))
        .select("year", "round", "stage_order", "home_team", "away_team", "home_score", "away_score", "winner")
        .orderBy("year", F.col("stage_order").asc_nulls_last(), "home_team", "away_team", "home_score", "away_score", "winner", "round")
    )


def favorite_by_round(wh: Warehouse) -> DataFrame:
    """Favourite hit rate per round with at least one decided match, in stage order."""
    per_round = favorite_rate(
        wh.ranking_vs_result, "round", extra=[F.any_value(stage_order("round"), True).alias("stage_order")]
    )
    return (
        per_round.where(F.col("decided") > 0)
        .select("round", "stage_order", "decided", F.col("favorite_won").alias("favorite_wins"), "favorite_win_pct")
        .orderBy(F.col("stage_order").asc_nulls_last(), "round")
    )


# ------------------------------------------------------------------ pages


def calibration(wh: Warehouse) -> DataFrame:
    """Goals against xG per match, with a fixture label."""
    m = matches_extract(wh)
    return m.select(
        "year", "round",
        F.concat(F.col("home_team"), F.lit(FIXTURE_SEPARATOR), F.col("away_team")).alias("fixture"),
        "total_goals", "xg_total",
        round_half_away(F.col("total_goals") - F.col("xg_total"), 2).alias("delta"),
    ).orderBy(F.col("xg_total").asc_nulls_last(), "fixture", "year", "round", "total_goals")


def goals_histogram(wh: Warehouse) -> DataFrame:
    """A10: matches per (total goals, year)."""
    return (
        matches_extract(wh).groupBy("total_goals", "year")
        .agg(F.count(F.lit(1)).alias("matches"))
        .orderBy(F.col("total_goals").asc_nulls_last(), "year")
    )


def global_kpis(wh: Warehouse) -> DataFrame:
    """Totals over editions."""
    return wh.edition_kpis.agg(
        F.sum("n_matches").alias("matches"),
        F.sum("total_goals").alias("goals"),
        round_half_away(F.avg("goals_per_match"), 2).alias("avg_goals_per_match"),
        F.sum("pen_shootouts").alias("shootouts"),
    )


def prediction_perspective(preds: DataFrame) -> DataFrame:
    """One row per (fixture, team) with that team's win probability."""
    sides = F.array(
        F.struct(F.col("home_team").alias("team"), F.col("prob_home_win").alias("win_prob")),
        F.struct(F.col("away_team").alias("team"), F.col("prob_away_win").alias("win_prob")),
    )
    return preds.select("date", "home_team", "away_team", F.inline(sides))


def team_win_prob(preds: DataFrame, k: int = 15) -> DataFrame:
    """Mean projected win probability per team (percent), top k.

    The probabilities are 4-decimal numbers, so the mean is taken in exact
    decimal arithmetic: a mean that is exactly on a rounding boundary
    (36.95) rounds the same way on every cluster, whatever the summation order."""
    pct = F.round(F.avg(F.col("win_prob").cast("decimal(12,4)")) * F.lit(100), 1).cast("double")
    return (
        prediction_perspective(preds)
        .groupBy("team")
        .agg(
            pct.alias("avg_win_pct"),
            F.count(F.lit(1)).alias("matches"),
        )
        .orderBy(F.col("avg_win_pct").desc(), "team")
        .limit(k)
    )


def total_decided(wh: Warehouse) -> DataFrame:
    """Decided matches over all rounds."""
    return favorite_by_round(wh).agg(F.sum("decided").alias("decided"))


def sample_size_labels(wh: Warehouse) -> DataFrame:
    """P20: 'n=<decided>' label per round."""
    return favorite_by_round(wh).withColumn("n_label", F.concat(F.lit("n="), F.col("decided").cast("string")))


def compounding(wh: Warehouse, games: int = 7) -> DataFrame:
    """Chance to win n games in a row at the observed knockout hit rate
    of the favourite (p^n for n = 1..games)."""
    ko = wh.ranking_vs_result.where(F.col("round") != config.GROUP_STAGE)
    p = ko.agg(
        (F.count_if(F.col("favorite_won")) / F.nullif(F.count_if(F.col("favorite_won").isNotNull()), F.lit(0))).alias("p")
    )
    return p.select(F.explode(F.sequence(F.lit(1), F.lit(games))).alias("games"), "p").select(
        "games", round_half_away(F.pow(F.col("p"), F.col("games")), 6).alias("prob_title")
    )


def efficiency_quadrant(wh: Warehouse, min_matches: int = config.MIN_MATCHES_TOP) -> DataFrame:
    """M18 (P16): team-edition points with both xG deltas, minimum sample."""
    return (
        wh.team_performance.where(F.col("matches") >= min_matches)
        .select("team", "year", "matches", "attack_vs_xg", "defense_vs_xg", "goal_diff")
        .orderBy((F.col("attack_vs_xg") + F.col("defense_vs_xg")).desc(), "team", "year")
    )


def team_lookup(wh: Warehouse, team: str, year: int) -> DataFrame:
    """One team in one edition, name matched case-insensitively (a literal, no SQL text)."""
    return wh.team_performance.where(
        (F.lower(F.col("team")) == F.lower(F.lit(team))) & (F.col("year") == F.lit(int(year)))
    ).select("team", "year", "matches", "goals_for", "xg_for", "attack_vs_xg",
             "goals_against", "xg_against", "defense_vs_xg", "goal_diff")


def fixture_lookup(preds: DataFrame, team_a: str, team_b: str) -> DataFrame:
    """The predicted fixture between two teams in either orientation."""
    h, a = F.lower(F.col("home_team")), F.lower(F.col("away_team"))
    x, y = F.lower(F.lit(team_a)), F.lower(F.lit(team_b))
    return preds.where(((h == x) & (a == y)) | ((h == y) & (a == x)))


# ------------------------------------------------------------------ clustered extracts


def write_lookup_extracts(wh: Warehouse, folder: str, preds: DataFrame | None = None, files: int | None = None, row_group_bytes: int = 8 << 20) -> None:
    """S13 for lookups: matches, team performance and (if given) predictions under ``folder``, clustered by
    edition, stage and date, with bloom filters on lower-case team names (``*_key``). Lookups
    compare the keys with a constant, which reaches the Parquet reader; ``lower(team)`` does not."""
    key = lambda c: F.lower(F.col(c)).alias(f"{c.removesuffix('_team')}_key")
    options = {"files": files, "row_group_bytes": row_group_bytes}
    matches = wh.int_match_stages.select("*", key("home_team"), key("away_team"))
    sinks.write_clustered(matches, f"{folder}/matches", ["year", "stage_order", "match_date"], ["home_key", "away_key"], **options)
    teams = wh.team_performance.select("*", key("team"))
    sinks.write_clustered(teams, f"{folder}/teams", ["year", "team_key"], ["team_key"], **options)
    if preds is not None:
        fixtures = preds.select("*", key("home_team"), key("away_team"))
        sinks.write_clustered(fixtures, f"{folder}/fixtures", ["date", "home_key"], ["home_key", "away_key"], **options)


def _is(column: str, name: str) -> Column:
    return F.col(column) == F.lower(F.lit(name))  # folded to a constant


def team_lookup_extract(spark: SparkSession, folder: str, team: str, year: int) -> DataFrame:
    """P17 over the extract."""
    found = spark.read.parquet(f"{folder}/teams").where((F.col("year") == F.lit(int(year))) & _is("team_key", team))
    return found.select("team", "year", "matches", "goals_for", "xg_for", "attack_vs_xg", "goals_against", "xg_against", "defense_vs_xg", "goal_diff")


def fixture_lookup_extract(spark: SparkSession, folder: str, team_a: str, team_b: str) -> DataFrame:
    """P18 over the extract."""
    either = (_is("home_key", team_a) & _is("away_key", team_b)) | (_is("home_key", team_b) & _is("away_key", team_a))
    return spark.read.parquet(f"{folder}/fixtures").where(either).drop("home_key", "away_key")


def team_matches_extract(spark: SparkSession, folder: str, team: str, year: int) -> DataFrame:
    """All matches of a team in an edition, in the order of the extract."""
    mine = spark.read.parquet(f"{folder}/matches").where((F.col("year") == F.lit(int(year))) & (_is("home_key", team) | _is("away_key", team)))
    return mine.select("year", "round", "stage_order", "match_date", "home_team", "away_team", "home_score", "away_score", "winner")


def predictions_extract(wh: Warehouse) -> DataFrame:
    """Predictions in dashboard order (date, home team)."""
    return pr.predictions(wh).select(*pr.PREDICTION_COLUMNS)
