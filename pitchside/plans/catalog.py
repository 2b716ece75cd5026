"""The registered queries of the inventory (see ``registry.py``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.operators import marts
from pitchside.plans import questions as q
from pitchside.plans.layers import Warehouse
from pitchside.plans.registry import MATCH_KEYS, register

# ---------------------------------------------------------------- staging


@register("p1_stg_matches")
def p1(wh: Warehouse) -> DataFrame:
    """stg.matches: renamed, scoped, with all derived outcome columns."""
    return wh.stg_matches


@register("p2_derived_measures")
def p2(wh: Warehouse) -> DataFrame:
    return wh.stg_matches.select(*MATCH_KEYS, "home_score", "away_score", "total_goals", "home_goal_diff")


@register("p3_decided_on_pens")
def p3(wh: Warehouse) -> DataFrame:
    return wh.stg_matches.select(*MATCH_KEYS, "home_pens", "away_pens", "decided_on_pens")


@register("p4_result_regulation")
def p4(wh: Warehouse) -> DataFrame:
    return wh.stg_matches.select(*MATCH_KEYS, "home_score", "away_score", "result_regulation")


@register("p5_winner")
def p5(wh: Warehouse) -> DataFrame:
    return wh.stg_matches.select(*MATCH_KEYS, "home_score", "away_score", "home_pens", "away_pens", "winner")


@register("p6_goals_minus_xg")
def p6(wh: Warehouse) -> DataFrame:
    return wh.stg_matches.select(*MATCH_KEYS, "total_goals", "home_xg", "away_xg", "goals_minus_xg")


@register("p7_stg_world_cup")
def p7(wh: Warehouse) -> DataFrame:
    return wh.stg_world_cup


@register("p8_stg_rankings")
def p8(wh: Warehouse) -> DataFrame:
    """Also U3 (UNION ALL of snapshots)."""
    return wh.stg_rankings


@register("p9_int_match_stages")
def p9(wh: Warehouse) -> DataFrame:
    return wh.int_match_stages


@register("p10_stage_order")
def p10(wh: Warehouse) -> DataFrame:
    return wh.int_match_stages.select(*MATCH_KEYS, "stage_type", "stage_order")


@register("p11_team_result")
def p11(wh: Warehouse) -> DataFrame:
    return wh.int_team_matches.select("year", "match_date", "round", "team", "opponent", "is_home", "result", "won_match")


@register("p12_higher_ranked")
def p12(wh: Warehouse) -> DataFrame:
    return wh.ranking_vs_result.select("round", "home_team", "away_team", "home_rank", "away_rank", "higher_ranked")


@register("p13_ranking_vs_result")
def p13(wh: Warehouse) -> DataFrame:
    return wh.ranking_vs_result


# ---------------------------------------------------------------- marts


@register("u1_int_team_matches")
def u1(wh: Warehouse) -> DataFrame:
    return wh.int_team_matches


@register("a1_edition_kpis")
def a1(wh: Warehouse) -> DataFrame:
    return wh.edition_kpis


@register("a2_knockout_analysis")
def a2(wh: Warehouse) -> DataFrame:
    return wh.knockout_analysis


@register("a3_team_performance")
def a3(wh: Warehouse) -> DataFrame:
    return wh.team_performance


@register("a4_team_strength_inputs")
def a4(wh: Warehouse) -> DataFrame:
    return wh.team_strength_inputs


@register("a6_filtered_counts")
def a6(wh: Warehouse) -> DataFrame:
    """count(*) FILTER (WHERE p): NULL predicates are not counted."""
    return wh.int_team_matches.groupBy("year").agg(
        F.count(F.lit(1)).alias("team_matches"),
        F.count_if(F.col("won_match")).alias("won"),
        F.count_if(~F.col("won_match")).alias("not_won"),
        F.count_if(F.col("decided_on_pens")).alias("on_pens"),
    )


@register("j1_matches_edition")
def j1(wh: Warehouse) -> DataFrame:
    """Left join match -> edition USING (year)."""
    w = wh.stg_world_cup.select("year", "champion", "runner_up")
    return wh.stg_matches.select(*MATCH_KEYS).join(w, "year", "left")


@register("j2_reconcile_names")
def j2(wh: Warehouse) -> DataFrame:
    """Team universe of the scope with its ranking-side name."""
    teams = wh.int_team_matches.select("team").distinct()
    return marts.reconcile(teams, "team", wh.crosswalk, "ranking_name")


@register("j3_side_ranks")
def j3(wh: Warehouse) -> DataFrame:
    """Rank joined once per role, over every match in scope."""
    ranks = marts.ranks_of_cycle(wh.stg_rankings, wh.scope.test_cycle)
    return marts.with_side_ranks(wh.stg_matches.select(*MATCH_KEYS), wh.crosswalk, ranks)


# ---------------------------------------------------------------- questions


@register("q1_edition_kpis")
def q1(wh: Warehouse) -> DataFrame:
    return q.q1_edition_kpis(wh)


@register("q2_top_attack")
def q2(wh: Warehouse) -> DataFrame:
    return q.q2_top_attack(wh)


@register("q3_top_defense")
def q3(wh: Warehouse) -> DataFrame:
    return q.q3_top_defense(wh)


@register("q4_knockout")
def q4(wh: Warehouse) -> DataFrame:
    return q.q4_knockout(wh)


@register("q5_favorite_by_phase")
def q5(wh: Warehouse) -> DataFrame:
    return q.q5_favorite_by_phase(wh)


@register("d1_round_frequency")
def d1(wh: Warehouse) -> DataFrame:
    return q.d1_round_frequency(wh)


@register("d2_unranked_teams")
def d2(wh: Warehouse) -> DataFrame:
    return q.d2_unranked_teams(wh)


@register("e1_team_performance")
def e1(wh: Warehouse) -> DataFrame:
    return q.e1_team_performance(wh)


@register("e2_efficiency_table")
def e2(wh: Warehouse) -> DataFrame:
    return q.e2_efficiency_table(wh)


# ---------------------------------------------------------------- model
from pitchside.functions.columns import round_half_away  # noqa: E402
from pitchside.operators import model  # noqa: E402
from pitchside.plans import backtest as bt  # noqa: E402
from pitchside.plans import predict as pr  # noqa: E402


def _pooled_stats(wh: Warehouse) -> DataFrame:
    return model.team_stats(wh.int_team_matches, None, wh.team_strength_inputs)


@register("a5_team_stats_scoped")
def a5(wh: Warehouse) -> DataFrame:
    """Training-scope stats straight from the team-match grain (unrounded xG)."""
    return model.team_stats(wh.int_team_matches, wh.scope.train_years)


@register("a14_league_average")
def a14(wh: Warehouse) -> DataFrame:
    """Pooled and training-scope league averages for the default (k, w)."""
    grid = model.default_grid()
    pooled = model.league_average(_pooled_stats(wh), grid).withColumn("scope", F.lit("pooled"))
    train = model.league_average(model.team_stats(wh.int_team_matches, wh.scope.train_years), grid).withColumn(
        "scope", F.lit("train")
    )
    return pooled.unionByName(train)


@register("m1_strength_pooled")
def m1(wh: Warehouse) -> DataFrame:
    """Shrunk attack/defense from pooled stats (J8: league average joined on the grid key)."""
    return model.team_strength(_pooled_stats(wh), model.default_grid())


@register("m2_strength_train")
def m2(wh: Warehouse) -> DataFrame:
    return model.team_strength(model.team_stats(wh.int_team_matches, wh.scope.train_years), model.default_grid())


@register("u4_schedule_teams")
def u4(wh: Warehouse) -> DataFrame:
    return model.schedule_teams(wh.raw.schedule)


@register("u5_edition_teams")
def u5(wh: Warehouse) -> DataFrame:
    return model.edition_teams(wh.int_team_matches, wh.scope.test_year)


@register("m3_team_rankings")
def m3(wh: Warehouse) -> DataFrame:
    """Schedule universe with rank and points of the prediction cycle."""
    return pr.prediction_model(wh).rankings


@register("j4_test_rankings")
def j4(wh: Warehouse) -> DataFrame:
    """Test-edition universe with rank and points of the test cycle (cycle in the join)."""
    return bt.backtest_model(wh, model.default_grid()).rankings


@register("m4_team_features")
def m4(wh: Warehouse) -> DataFrame:
    """Rankings left-joined with pooled strength (J5) and has_history."""
    return pr.prediction_model(wh).features


@register("m5_fallback_fit")
def m5(wh: Warehouse) -> DataFrame:
    """attack/defense ~ points on teams with history."""
    return pr.prediction_model(wh).fit


@register("m6_apply_fallback")
def m6(wh: Warehouse) -> DataFrame:
    return pr.prediction_model(wh).full


@register("j6_schedule_strength")
def j6(wh: Warehouse) -> DataFrame:
    """Each fixture with both sides' filled strength (the two-role join)."""
    sm = pr.prediction_model(wh)
    return sm.score(pr.schedule(wh)).select(
        "round", "date", "home_team", "away_team", "attack_home", "defense_home", "attack_away", "defense_away"
    )


@register("m9_outcome_probs", materialize=True)
def m9(wh: Warehouse) -> DataFrame:
    """Expected goals and W/D/L probabilities of every distinct test pairing."""
    sm = bt.backtest_model(wh, model.default_grid())
    pairs = bt.holdout_matches(wh).select("home_team", "away_team").distinct()
    return sm.score(pairs).select("home_team", "away_team", "mu_home", "mu_away", "prob_home_win", "prob_draw", "prob_away_win")


@register("m10_predictions")
def m10(wh: Warehouse) -> DataFrame:
    return pr.predictions(wh)


@register("a20_prob_sum_check")
def a20(wh: Warehouse) -> DataFrame:
    return pr.probability_sum_check(pr.predictions(wh))


@register("m11_predicted_label", materialize=True)
def m11(wh: Warehouse) -> DataFrame:
    return bt.scored_test_matches(wh).select(*MATCH_KEYS, "actual", "predicted")


@register("m12_favorite_label", materialize=True)
def m12(wh: Warehouse) -> DataFrame:
    return bt.scored_test_matches(wh).select(*MATCH_KEYS, "actual", "favorite_pred")


@register("m13_scored_test_matches", materialize=True)
def m13(wh: Warehouse) -> DataFrame:
    return bt.scored_test_matches(wh).select(
        *MATCH_KEYS, "home_score", "away_score", "actual", "prob_home_win", "prob_draw", "prob_away_win",
        "predicted", "favorite_pred", *bt.METRICS,
    )


@register("a16_naive_baseline")
def a16(wh: Warehouse) -> DataFrame:
    return bt.naive_baseline(wh)


@register("a17_accuracy", materialize=True)
def a17(wh: Warehouse) -> DataFrame:
    return bt.metric_means(wh).select(*[round_half_away(m, 6).alias(m) for m in ("model_acc", "naive_acc", "favorite_acc")])


@register("a18_log_loss", materialize=True)
def a18(wh: Warehouse) -> DataFrame:
    return bt.metric_means(wh).select(*[round_half_away(m, 6).alias(m) for m in ("model_ll", "naive_ll")])


@register("m14_backtest", materialize=True)
def m14(wh: Warehouse) -> DataFrame:
    return bt.backtest(wh)


@register("m15_bootstrap_poisson", materialize=True)
def m15(wh: Warehouse) -> DataFrame:
    """The back-test table with Poisson-weight bootstrap intervals (the scale path)."""
    return bt.backtest(wh, method="poisson")


@register("m16_sweep", materialize=True)
def m16(wh: Warehouse) -> DataFrame:
    return bt.sweep(wh)


# ---------------------------------------------------------------- dashboard and EDA
from pitchside.plans import dashboard as db  # noqa: E402

LOOKUP_TEAM, LOOKUP_YEAR = "nation_7", 2000  # lower case on purpose: the match is case-insensitive
FIXTURE_A, FIXTURE_B = "europe", "NATION_3"  # scheduled as NATION_3 (home) v EUROPE (away)


@register("p14_eda_matches")
def p14(wh: Warehouse) -> DataFrame:
    return db.matches_eda(wh)


@register("p15_calibration")
def p15(wh: Warehouse) -> DataFrame:
    return db.calibration(wh)


@register("p16_min_sample")
def p16(wh: Warehouse) -> DataFrame:
    """Team-editions with at least 4 matches (minimum-sample filter)."""
    return wh.team_performance.where(F.col("matches") >= 4)


@register("p17_team_lookup")
def p17(wh: Warehouse) -> DataFrame:
    return db.team_lookup(wh, LOOKUP_TEAM, LOOKUP_YEAR)


@register("p18_fixture_lookup")
def p18(wh: Warehouse) -> DataFrame:
    return db.fixture_lookup(pr.predictions(wh), FIXTURE_A, FIXTURE_B)


@register("p19_shootouts")
def p19(wh: Warehouse) -> DataFrame:
    return db.shootouts(wh)


@register("p20_sample_size_label")
def p20(wh: Warehouse) -> DataFrame:
    return db.sample_size_labels(wh)


@register("a8_favorite_by_round")
def a8(wh: Warehouse) -> DataFrame:
    return db.favorite_by_round(wh)


@register("a10_goals_histogram")
def a10(wh: Warehouse) -> DataFrame:
    return db.goals_histogram(wh)


@register("a11_global_kpis")
def a11(wh: Warehouse) -> DataFrame:
    return db.global_kpis(wh)


@register("a12_round_frequency")
def a12(wh: Warehouse) -> DataFrame:
    return q.d1_round_frequency(wh)


@register("a13_team_win_prob")
def a13(wh: Warehouse) -> DataFrame:
    return db.team_win_prob(pr.predictions(wh))


@register("u2_prediction_perspective")
def u2(wh: Warehouse) -> DataFrame:
    return db.prediction_perspective(pr.predictions(wh))


@register("a21_total_decided")
def a21(wh: Warehouse) -> DataFrame:
    return db.total_decided(wh)


@register("m17_compounding")
def m17(wh: Warehouse) -> DataFrame:
    return db.compounding(wh)


@register("m18_efficiency_quadrant")
def m18(wh: Warehouse) -> DataFrame:
    return db.efficiency_quadrant(wh)


@register("s13_extract_matches")
def s13m(wh: Warehouse) -> DataFrame:
    return db.matches_extract(wh)


@register("s13_extract_predictions")
def s13p(wh: Warehouse) -> DataFrame:
    return db.predictions_extract(wh)


@register("s5_layer_counts", materialize=True)
def s5(wh: Warehouse) -> DataFrame:
    return wh.layer_counts()


# ---------------------------------------------------------------- governed access
from pitchside.plans import access  # noqa: E402
from pitchside.sources import sinks, store  # noqa: E402

GOVERNED_SQL = """
    SELECT team, year, matches, attack_vs_xg, defense_vs_xg
    FROM {table}
    WHERE year = 2000
    ORDER BY attack_vs_xg + defense_vs_xg DESC, team
"""


@register("g1_governed_query")
def g1(wh: Warehouse) -> DataFrame:
    """Publish the mart (S9, with dictionary comments) in a database of this
    run's own, then send a user query through the gate with a row cap of 10."""
    import uuid

    spark = wh.stg_matches.sparkSession
    run = uuid.uuid4().hex
    table = f"{store.database_prefix(spark)}governed_{run}.team_performance"
    path = f"{store.folder(spark)}/published-{run}/team_performance"
    sinks.save_table(spark, access.with_comments(wh.team_performance), table, path)
    return access.bounded_query(spark, GOVERNED_SQL.format(table=table), allowed=frozenset({table}), max_rows=10)


@register("s4_catalog_profile")
def s4(wh: Warehouse) -> DataFrame:
    """Row count and (position, column, type) of every raw table, all editions."""
    from pitchside.sources import bridge, files

    raw = bridge.load_raw(wh.raw.spark, wh.raw.star.sf_dir)
    return files.catalog_profile(
        {"matches": raw.matches, "world_cup": raw.world_cup, "schedule": raw.schedule, **raw.rankings}
    )


# ---------------------------------------------------------------- round trips of sources and sinks


def _run_folder(wh: Warehouse, name: str) -> str:
    import uuid

    return f"{store.folder(wh.raw.spark)}/{name}-{uuid.uuid4().hex}"


@register("s1_csv_source")
def s1(wh: Warehouse) -> DataFrame:
    """The scoped raw matches written as CSV with columns in another order and one
    more, read back by header name."""
    from pitchside.sources import files
    from pitchside.sources.schemas import MATCHES

    folder = _run_folder(wh, "csv")
    m = wh.raw.matches
    sinks.write_csv(m.select(F.lit(0).alias("unknown"), *reversed(m.columns)), folder)
    return files.read_csv(wh.raw.spark, folder, MATCHES)


@register("s1_csv_rejects")
def s1_rejects(wh: Warehouse) -> DataFrame:
    """The scoped raw matches as CSV in which an attendance over 60,000 is the word "full" and
    the dates of matches with 5 goals or more are in another format; rows by what became of them."""
    from pitchside.sources import files
    from pitchside.sources.schemas import MATCHES

    folder = _run_folder(wh, "csv")
    m = wh.raw.matches
    goals = F.col("home_score") + F.col("away_score")
    spoilt = m.withColumns({
        "Attendance": F.when(F.col("Attendance") > 60_000, "full").otherwise(F.col("Attendance").cast("string")),
        "Date": F.when(goals >= 5, F.date_format("Date", "dd.MM.yyyy")).otherwise(F.col("Date").cast("string")),
    })
    sinks.write_csv(spoilt, folder)
    good, rejects, _ = files.load_csv(wh.raw.spark, folder, MATCHES, _run_folder(wh, "staged"), max_error_share=1.0)
    count = lambda df, reason: df.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return count(good, F.lit("read")).unionByName(count(rejects, F.col("reason")))


def _incremental(wh: Warehouse) -> dict[str, DataFrame]:
    """Marts of a state that was folded edition by edition, with one edition first taken from its
    group stage alone and replaced later."""
    from pitchside.operators.incremental import MartState

    m = wh.stg_matches
    state = MartState(wh.raw.spark, _run_folder(wh, "state"))
    *others, last = wh.scope.years
    state.fold(m.where((F.col("year") == last) & (F.col("round") == "Group stage")), "early")
    for year in others:
        state.fold(m.where(F.col("year") == year), f"edition {year}")
    state.fold(m.where(F.col("year") == last), "late", replace=[last])
    return state.marts(wh.stg_world_cup)


@register("a1_incremental_kpis", materialize=True)
def a1_incremental(wh: Warehouse) -> DataFrame:
    return _incremental(wh)["edition_kpis"]


@register("a2_incremental_knockout", materialize=True)
def a2_incremental(wh: Warehouse) -> DataFrame:
    return _incremental(wh)["knockout_analysis"]


@register("a3_incremental_performance", materialize=True)
def a3_incremental(wh: Warehouse) -> DataFrame:
    return _incremental(wh)["team_performance"]


@register("a4_incremental_strength", materialize=True)
def a4_incremental(wh: Warehouse) -> DataFrame:
    return _incremental(wh)["team_strength_inputs"]


@register("p1_colocated_matches")
def p1_colocated(wh: Warehouse) -> DataFrame:
    """P1 over orders and line items that were bucketed by order key: the join has no exchange."""
    from pitchside.plans.layers import Warehouse as Layers
    from pitchside.sources import bridge, colocated

    spark, sf_dir = wh.raw.spark, wh.raw.star.sf_dir
    raw = bridge.load_raw(spark, sf_dir, wh.scope.years, colocated.colocated_star(spark, sf_dir))
    return Layers(raw, wh.scope).stg_matches


@register("p17_clustered_lookup")
def p17_clustered(wh: Warehouse) -> DataFrame:
    folder = _run_folder(wh, "extracts")
    db.write_lookup_extracts(wh, folder)
    return db.team_lookup_extract(wh.raw.spark, folder, LOOKUP_TEAM, LOOKUP_YEAR)


@register("p18_clustered_fixture")
def p18_clustered(wh: Warehouse) -> DataFrame:
    folder = _run_folder(wh, "extracts")
    db.write_lookup_extracts(wh, folder, pr.predictions(wh))
    return db.fixture_lookup_extract(wh.raw.spark, folder, FIXTURE_A, FIXTURE_B)


@register("s13_team_matches")
def s13_team_matches(wh: Warehouse) -> DataFrame:
    """The matches of one team in one edition from the clustered match extract."""
    folder = _run_folder(wh, "extracts")
    db.write_lookup_extracts(wh, folder)
    return db.team_matches_extract(wh.raw.spark, folder, LOOKUP_TEAM, LOOKUP_YEAR)


@register("g3_data_dictionary", materialize=True)
def g3(wh: Warehouse) -> DataFrame:
    """Every documented column of the published relations with its row and value counts."""
    from pitchside.plans.pipeline import published_relations

    return access.dictionary_profile(published_relations(wh))


@register("s2_csv_job")
def s2(wh: Warehouse) -> DataFrame:
    """The raw sources of the scope written as CSV files, checked, and taken through ingest and build
    of the batch job; the row counts of the layers."""
    from pitchside.plans.pipeline import run_pipeline
    from pitchside.sources.schemas import RAW_SOURCES

    spark, folder = wh.raw.spark, _run_folder(wh, "sources")
    tables = {"matches": wh.raw.matches, "world_cup": wh.raw.world_cup, "schedule": wh.raw.schedule, **wh.raw.rankings}
    for name, (file, _) in RAW_SOURCES.items():
        sinks.write_csv(tables[name], f"{folder}/{file}")
    counts = run_pipeline(spark, f"{folder}/out", csv_dir=folder, steps=("ingest", "build")).layer_counts
    return spark.createDataFrame(list(counts.items()), "relation string, n_rows long")


@register("s12_scalar")
def s12(wh: Warehouse) -> DataFrame:
    """The total number of matches as one value, and each edition's share of it."""
    from pitchside.sources import files

    total = files.scalar(wh.stg_matches.agg(F.count(F.lit(1))))
    return wh.stg_matches.groupBy("year").agg((F.count(F.lit(1)) / F.lit(float(total))).alias("share"), F.lit(total).cast("long").alias("total"))


@register("s3_replace_table")
def s3(wh: Warehouse) -> DataFrame:
    """S3: a raw table replaced by a new version; the old one does not show."""
    from pitchside.sources import files

    root = _run_folder(wh, "replaced")
    files.replace_table(wh.raw.rankings["ranking_old"], root)
    return files.replace_table(wh.raw.world_cup, root)[0]


@register("s7_csv_sink")
def s7(wh: Warehouse) -> DataFrame:
    """The predictions as CSV, read back."""
    from pitchside.sources import files

    preds = pr.predictions(wh)
    folder = _run_folder(wh, "predictions_csv")
    sinks.write_csv(preds, folder)
    return files.read_csv(wh.raw.spark, folder, preds.schema)


# what team performance and knockout analysis need of a match
MART_MATCH_COLS = (
    "year", "match_date", "round", "host", "home_team", "away_team", "home_score", "away_score", "home_xg", "away_xg",
    "home_pens", "away_pens", "total_goals", "decided_on_pens", "winner",
)


@register("s9_publish_snapshot")
def s9(wh: Warehouse) -> DataFrame:
    """Two marts published twice under a database of this run's own; rows by relation, from
    the snapshot as readers open it and from the catalog.

    The matches are joined once: what the marts read of them is written, and all four writes of
    marts start from these files."""
    spark = wh.raw.spark
    folder = _run_folder(wh, "snapshot")
    wh = wh.with_written_matches(MART_MATCH_COLS)
    db = f"{store.database_prefix(spark)}published_{folder.rsplit('-', 1)[1]}"
    rel = {f"{db}.team_performance": wh.team_performance, f"{db}.knockout_analysis": wh.knockout_analysis}
    for _ in range(2):
        sinks.publish(spark, rel, folder)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).join(spark.table(t).agg(F.count(F.lit(1)).alias("n_rows")), "n_rows").select(F.lit(t.split(".")[1]).alias("relation"), "n_rows")
        for t, df in sinks.open_snapshot(spark, folder).items()
    ]
    return parts[0].unionByName(parts[1])


@register("s11_batch_job")
def s11(wh: Warehouse) -> DataFrame:
    """The whole job into a folder and databases of its own; its published predictions."""
    from pitchside.plans.pipeline import run_pipeline

    folder = _run_folder(wh, "job")
    prefix = f"{store.database_prefix(wh.raw.spark)}job_{folder.rsplit('-', 1)[1]}_"
    run_pipeline(wh.raw.spark, folder, sf_dir=wh.raw.star.sf_dir, prefix=prefix)
    return wh.raw.spark.table(f"{prefix}predict.predictions")
