"""Oracle SQL of the dashboard extracts and page queries."""

from __future__ import annotations

from oracle.base import register_ctes

register_ctes(
    """
mx AS (
    SELECT * EXCLUDE (match_date, host, venue, attendance, home_pens, away_pens, home_manager, away_manager, home_captain, away_captain,
                      referee, notes, home_goal_diff, result_regulation, goals_minus_xg, stage_order), home_xg + away_xg AS xg_total
    FROM int_match_stages
),
fav_round AS (
    SELECT f.round, s.stage_order, f.decided, CAST(f.won AS BIGINT) AS favorite_wins, round(100.0 * f.won / f.decided, 1) AS favorite_win_pct
    FROM favourite_sums f JOIN stage_list s USING (round) WHERE f.decided > 0
),
pred_sides AS (
    SELECT date, home_team, away_team, s.team, s.win_prob FROM (
        SELECT *, unnest([{'team': home_team, 'win_prob': prob_home_win}, {'team': away_team, 'win_prob': prob_away_win}]) AS s FROM predictions)
)
"""
)

BODIES: dict[str, str] = {
    "p14_eda_matches": """
        SELECT mx.*, i.stage_order FROM mx JOIN stage_list i USING (round)""",
    "p15_calibration": """
        SELECT year, round, concat_ws(' × ', home_team, away_team) AS fixture, total_goals, xg_total, round(total_goals - xg_total, 2) AS delta FROM mx""",
    "p16_min_sample": "SELECT * FROM team_performance WHERE matches >= 4",
    "p17_team_lookup": """
        SELECT * EXCLUDE (wins_reg, draws, losses_reg, advanced_or_won) FROM team_performance WHERE team ILIKE 'nation_7' AND year = 2000""",
    "p18_fixture_lookup": """
        SELECT * FROM predictions WHERE list_sort([lower(home_team), lower(away_team)]) = ['europe', 'nation_3']""",
    "p17_clustered_lookup": """
        SELECT * EXCLUDE (wins_reg, draws, losses_reg, advanced_or_won) FROM team_performance WHERE lower(team) = 'nation_7' AND year = 2000""",
    "p18_clustered_fixture": """
        SELECT * FROM predictions WHERE lower(home_team) IN ('europe', 'nation_3') AND lower(away_team) IN ('europe', 'nation_3') AND home_team <> away_team""",
    "s13_team_matches": """
        SELECT year, round, stage_order, match_date, home_team, away_team, home_score, away_score, winner FROM int_match_stages
        WHERE year = 2000 AND 'NATION_7' IN (home_team, away_team)""",
    "p19_shootouts": """
        SELECT m.year, m.round, s.stage_order, m.home_team, m.away_team, m.home_score, m.away_score, m.winner
        FROM stg_matches m, stage_list s WHERE s.round = m.round AND coalesce(m.home_pens, 0) + coalesce(m.away_pens, 0) > 0""",
    "p20_sample_size_label": "SELECT *, concat('n=', decided) AS n_label FROM fav_round",
    "a8_favorite_by_round": "SELECT * FROM fav_round",
    "a10_goals_histogram": "SELECT total_goals, year, count(*) AS matches FROM stg_matches GROUP BY ALL",
    "a11_global_kpis": """
        SELECT CAST(sum(n_matches) AS BIGINT) AS matches, CAST(sum(total_goals) AS BIGINT) AS goals,
               round(avg(goals_per_match), 2) AS avg_goals_per_match, CAST(sum(pen_shootouts) AS BIGINT) AS shootouts
        FROM edition_kpis""",
    "a12_round_frequency": "SELECT round, count(*) AS n FROM stg_matches GROUP BY round",
    "a13_team_win_prob": """
        SELECT team, pct AS avg_win_pct, n AS matches FROM (
            SELECT team, count(*) AS n, round(100.0 * avg(win_prob), 1) AS pct, row_number() OVER (ORDER BY round(100.0 * avg(win_prob), 1) DESC, team) AS place
            FROM pred_sides GROUP BY team) WHERE place <= 15""",
    "u2_prediction_perspective": "SELECT * FROM pred_sides",
    "a21_total_decided": "SELECT CAST(sum(decided) AS BIGINT) AS decided FROM fav_round",
    "m17_compounding": """
        SELECT CAST(n AS INTEGER) AS games, round(pow(p, n), 6) AS prob_title
        FROM (SELECT CAST(sum(won) AS DOUBLE) / nullif(sum(decided), 0) AS p, unnest(range(1, 8)) AS n
              FROM favourite_sums JOIN stage_list USING (round) WHERE stage_order > 1)""",
    "m18_efficiency_quadrant": "SELECT team, year, matches, attack_vs_xg, defense_vs_xg, goal_diff FROM team_performance WHERE matches >= 4",
    "s13_extract_matches": "SELECT * FROM mx",
    "s13_extract_predictions": "SELECT * FROM predictions",
    "g1_governed_query": """
        SELECT * EXCLUDE (place) FROM (
            SELECT team, year, matches, attack_vs_xg, defense_vs_xg, row_number() OVER (ORDER BY attack_vs_xg + defense_vs_xg DESC, team) AS place
            FROM team_performance WHERE year = 2000) WHERE place <= 10""",
    "s5_layer_counts": """
        SELECT relation, n_rows FROM (
            SELECT (SELECT count(*) FROM stg_matches) AS "stg.matches", (SELECT 2 * count(*) FROM stg_matches) AS "mart.int_team_matches",
                   (SELECT count(*) FROM both_sums) AS "mart.team_performance", (SELECT count(DISTINCT team) FROM both_sums) AS "mart.team_strength_inputs",
                   (SELECT count(*) FROM year_sums) AS "mart.edition_kpis", (SELECT count(*) FROM knockout_analysis) AS "mart.knockout_analysis",
                   (SELECT count(*) FROM ranking_vs_result) AS "mart.ranking_vs_result")
        UNPIVOT (n_rows FOR relation IN (COLUMNS(*)))""",
}
BODIES["s2_csv_job"] = BODIES["s5_layer_counts"]
