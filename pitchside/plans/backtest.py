"""Back-test of the match model.

Strength is trained on the training editions only and scored on the test
edition, with ranking points of the test cycle for the fallback; no result
of the test edition reaches the model. The naive baseline predicts with the
outcome shares of the training editions; the favourite baseline says the
better-ranked side wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import argmax_label, log_loss_term, prob_of_outcome, round_half_away
from pitchside.operators import model, resample
from pitchside.plans.layers import Warehouse
from pitchside.sources import store

OUTCOMES = ("home_win", "draw", "away_win")
# Every column of a match row: the total order behind the bootstrap index.
MATCH_ORDER = (
    "year", "match_date", "host", "round", "venue", "attendance", "home_team", "away_team",
    "home_score", "away_score", "home_xg", "away_xg", "home_pens", "away_pens",
    "home_manager", "away_manager", "home_captain", "away_captain", "referee", "notes",
)


def match_hash() -> list:
    """What is hashed of a match row: every column, doubles as scaled integers so that
    the text is the same in any engine."""
    return [F.floor(F.col(c) * 1_000_000 + 0.5).cast("bigint") if c in ("home_xg", "away_xg") else F.col(c) for c in MATCH_ORDER]


METRICS = ("model_acc", "model_ll", "naive_acc", "naive_ll", "favorite_acc")
CLASS_KEY = ("home_team", "away_team", "actual")  # matches with these in common have equal metrics


def holdout_matches(wh: Warehouse) -> DataFrame:
    """Matches of the test (hold-out) edition."""
    return wh.int_match_stages.where(F.col("year") == wh.scope.test_year)


def backtest_model(wh: Warehouse, grid: model.Grid) -> model.StrengthModel:
    """Train on ``train_years``; the universe is the test edition's teams."""
    stats = store.materialize(model.team_stats(wh.int_team_matches, wh.scope.train_years), "team_stats")
    rankings = model.team_rankings(
        model.edition_teams(wh.int_team_matches, wh.scope.test_year),
        wh.crosswalk, wh.stg_rankings, wh.scope.test_cycle,
    )
    return model.StrengthModel(stats, rankings, grid)


def predicted_label(df: DataFrame) -> DataFrame:
    """Argmax of the three probabilities, ties home > draw > away."""
    return df.withColumn(
        "predicted", argmax_label(F.col("prob_home_win"), F.col("prob_draw"), F.col("prob_away_win"))
    )


def favorite_label(home_rank, away_rank):
    """home_win iff the home side is strictly better ranked, else away_win (never draw)."""
    return F.when(home_rank < away_rank, F.lit("home_win")).otherwise(F.lit("away_win"))


def naive_baseline(wh: Warehouse) -> DataFrame:
    """Outcome shares of the training editions, one row per outcome,
    with the flag of the predicted (most frequent) outcome."""
    train = wh.int_match_stages.where(F.col("year").isin(list(wh.scope.train_years)))
    r = F.col("result_regulation")
    n = F.count(F.lit(1)).cast("double")
    shares = train.agg(*[(F.count_if(r == o).cast("double") / n).alias(o) for o in OUTCOMES])
    pred = argmax_label(F.col("home_win"), F.col("draw"), F.col("away_win"))
    return shares.select(
        F.inline(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("share"), (pred == o).alias("is_predicted")) for o in OUTCOMES]))
    )


def scored_pairs(wh: Warehouse, k: float = config.SHRINKAGE_K, w: float = config.BLEND_WEIGHT) -> DataFrame:
    """One row per (home, away) pairing of the test edition: model probabilities and both
    labels. Written once, so that its true size is known: Spark then broadcasts it by
    its own size check, and match rows are not exchanged."""
    sm = backtest_model(wh, model.default_grid(k, w))
    pairs = holdout_matches(wh).select("home_team", "away_team").distinct()
    scores = sm.score(pairs).select("home_team", "away_team", "prob_home_win", "prob_draw", "prob_away_win")
    ranks = sm.rankings
    rh = ranks.select(F.col("team").alias("home_team"), F.col("rank").alias("home_rank"))
    ra = ranks.select(F.col("team").alias("away_team"), F.col("rank").alias("away_rank"))
    full = predicted_label(scores.join(rh, "home_team", "left").join(ra, "away_team", "left"))
    return store.materialize(
        full.withColumn("favorite_pred", favorite_label(F.col("home_rank"), F.col("away_rank"))).drop("home_rank", "away_rank"), "scored_pairs"
    )


def _with_metrics(rows: DataFrame, wh: Warehouse, pairs: DataFrame) -> DataFrame:
    """Adds the labels, probabilities and metrics to rows of (home_team, away_team, actual)."""
    naive = F.broadcast(  # three rows, one per outcome
        naive_baseline(wh).select(
            F.col("outcome").alias("actual"), F.col("share").alias("naive_p"), F.col("is_predicted").alias("_naive_hit")
        )
    )
    p_actual = prob_of_outcome(F.col("actual"), F.col("prob_home_win"), F.col("prob_draw"), F.col("prob_away_win"))
    return (
        rows.join(pairs, ["home_team", "away_team"], "left")
        .join(naive, "actual", "left")
        .withColumns(
            {
                "model_acc": (F.col("predicted") == F.col("actual")).cast("double"),
                "model_ll": log_loss_term(p_actual),
                "naive_acc": F.col("_naive_hit").cast("double"),
                "naive_ll": log_loss_term(F.col("naive_p")),
                "favorite_acc": (F.col("favorite_pred") == F.col("actual")).cast("double"),
            }
        )
    )


def scored_test_matches(
    wh: Warehouse, k: float = config.SHRINKAGE_K, w: float = config.BLEND_WEIGHT, pairs: DataFrame | None = None
) -> DataFrame:
    """One row per test match with actual outcome, model probabilities
    and label, favourite label and the per-match metrics.

    Scoring runs on distinct (home, away) pairs, so the Poisson grid is evaluated once
    per pairing; matches take the result by one join with the written pair frame."""
    test = holdout_matches(wh).select(*MATCH_ORDER, F.col("result_regulation").alias("actual"))
    return _with_metrics(test, wh, scored_pairs(wh, k, w) if pairs is None else pairs).select(
        *MATCH_ORDER, "actual", "prob_home_win", "prob_draw", "prob_away_win", "predicted", "favorite_pred", *METRICS
    )


def scored_classes(
    wh: Warehouse, k: float = config.SHRINKAGE_K, w: float = config.BLEND_WEIGHT, pairs: DataFrame | None = None
) -> DataFrame:
    """One row per (home, away, outcome) of the test matches: their number ``n`` and the metrics
    that they share."""
    counts = holdout_matches(wh).groupBy("home_team", "away_team", F.col("result_regulation").alias("actual")).agg(F.count(F.lit(1)).alias("n"))
    return _with_metrics(counts, wh, scored_pairs(wh, k, w) if pairs is None else pairs).select(*CLASS_KEY, "n", *METRICS)


def metric_means(
    wh: Warehouse, k: float = config.SHRINKAGE_K, w: float = config.BLEND_WEIGHT, classes: DataFrame | None = None
) -> DataFrame:
    """The mean of every metric over the test matches, one row: the metrics of each
    class weighed with its count."""
    rows = scored_classes(wh, k, w) if classes is None else classes
    mean = lambda m: F.sum(F.col("n") * F.col(m)) / F.sum(F.when(F.col(m).isNotNull(), F.col("n")))
    return rows.agg(*[mean(m).alias(m) for m in METRICS])


def _metric_rows() -> list[tuple[str, str, str]]:
    return [
        ("poisson", "accuracy", "model_acc"),
        ("poisson", "log_loss", "model_ll"),
        ("naive", "accuracy", "naive_acc"),
        ("naive", "log_loss", "naive_ll"),
        ("favorite", "accuracy", "favorite_acc"),
    ]


def backtest(
    wh: Warehouse,
    k: float = config.SHRINKAGE_K,
    w: float = config.BLEND_WEIGHT,
    n_resamples: int = config.BOOTSTRAP_RESAMPLES,
    seed: int = config.BOOTSTRAP_SEED,
    percentiles: tuple[float, float] = config.BOOTSTRAP_PERCENTILES,
    buckets: int = 256,
    digits: int = 6,
    method: str = "exact",
) -> DataFrame:
    """(model, metric, value, ci_lo, ci_hi) for the model and both
    baselines (A17 accuracy, A18 log-loss, M15 intervals). Values are
    reported to ``digits`` decimals. ``method`` picks the bootstrap (exact
    multinomial resampling, or Poisson weights for very large test sets)."""
    pairs = scored_pairs(wh, k, w)
    rows = _metric_rows()
    ranked = resample.rank_ranges(scored_classes(wh, k, w, pairs), CLASS_KEY, CLASS_KEY, "n", buckets)
    # written once: the means, the cells of the lookup and the values of the resamples read it
    classes = store.materialize(ranked, "backtest_classes")
    point_long = metric_means(wh, k, w, classes).select(
        F.inline(F.array(*[F.struct(F.lit(mod).alias("model"), F.lit(met).alias("metric"), F.lit(key).alias("key"), F.col(key).alias("value")) for mod, met, key in rows]))
    )
    if method == "poisson":
        per_match = scored_test_matches(wh, k, w, pairs).select(*MATCH_ORDER, *METRICS)
        observed = resample.keyed_rows(store.materialize(per_match, "backtest_per_match"), match_hash())
    else:
        observed = classes
    cis = resample.bootstrap_cis(observed, METRICS, n_resamples, seed, percentiles, method=method).withColumnRenamed("metric", "key")
    return (
        point_long.join(F.broadcast(cis), "key")  # one row per metric
        .select(
            "model", "metric",
            round_half_away("value", digits).alias("value"),
            round_half_away("ci_lo", digits).alias("ci_lo"),
            round_half_away("ci_hi", digits).alias("ci_hi"),
        )
        .orderBy("model", "metric")
    )


def sweep(
    wh: Warehouse,
    ks=config.SWEEP_K_GRID,
    ws=config.SWEEP_BLEND_GRID,
    default: tuple[float, float] = (config.SHRINKAGE_K, config.BLEND_WEIGHT),
    digits: int = 6,
) -> DataFrame:
    """M16 (T7): accuracy and log-loss of the back-test for every (k, w),
    in one query. Matches are first reduced to counts per (home, away,
    outcome), scored once per pair and grid point, then weighted back."""
    grid = model.sweep_grid(ks, ws)
    sm = backtest_model(wh, grid)
    test = holdout_matches(wh)
    counts = test.groupBy("home_team", "away_team", F.col("result_regulation").alias("actual")).agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = counts.select("home_team", "away_team").distinct()
    scored = predicted_label(sm.score(pairs))
    p_actual = prob_of_outcome(F.col("actual"), F.col("prob_home_win"), F.col("prob_draw"), F.col("prob_away_win"))
    weighted = scored.join(counts, ["home_team", "away_team"]).select(
        "k", "w", "n",
        (F.col("n") * (F.col("predicted") == F.col("actual")).cast("double")).alias("_hit"),
        (F.col("n") * log_loss_term(p_actual)).alias("_ll"),
    )
    total = F.sum("n").cast("double")
    out = weighted.groupBy("k", "w").agg(
        round_half_away(F.sum("_hit") / total, digits).alias("accuracy"),
        round_half_away(F.sum("_ll") / total, digits).alias("log_loss"),
    )
    is_default = (F.col("k") == float(default[0])) & (F.col("w") == float(default[1]))
    return out.select(
        "k", F.col("w").alias("blend_weight"), "accuracy", "log_loss", is_default.alias("is_default")
    ).orderBy("log_loss", "k", "blend_weight")
