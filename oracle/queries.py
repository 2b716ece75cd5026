"""Oracle SQL per registered query (DuckDB over the driver's tables)."""

from __future__ import annotations

from oracle.base import SCOPE_YEARS, TEST_CYCLE, TEST_YEAR, with_ctes

MK = "year, match_date, round, home_team, away_team"

_BODIES: dict[str, str] = {
    # staging
    "p1_stg_matches": "SELECT * FROM stg_matches",
    "p1_colocated_matches": "SELECT * FROM stg_matches",
    "p2_derived_measures": f"SELECT {MK}, home_score, away_score, total_goals, home_goal_diff FROM stg_matches",
    "p3_decided_on_pens": f"SELECT {MK}, home_pens, away_pens, decided_on_pens FROM stg_matches",
    "p4_result_regulation": f"SELECT {MK}, home_score, away_score, result_regulation FROM stg_matches",
    "p5_winner": f"SELECT {MK}, home_score, away_score, home_pens, away_pens, winner FROM stg_matches",
    "p6_goals_minus_xg": f"SELECT {MK}, total_goals, home_xg, away_xg, goals_minus_xg FROM stg_matches",
    "p7_stg_world_cup": "SELECT * FROM stg_world_cup",
    "p8_stg_rankings": "SELECT * FROM stg_rankings",
    "p9_int_match_stages": "SELECT * FROM int_match_stages",
    "p10_stage_order": f"SELECT {MK}, stage_type, stage_order FROM int_match_stages",
    "p11_team_result": "SELECT year, match_date, round, team, opponent, is_home, result, won_match FROM int_team_matches",
    "p12_higher_ranked": "SELECT round, home_team, away_team, home_rank, away_rank, higher_ranked FROM ranking_vs_result",
    "p13_ranking_vs_result": "SELECT * FROM ranking_vs_result",
    # marts
    "u1_int_team_matches": "SELECT * FROM int_team_matches",
    "a1_edition_kpis": "SELECT * FROM edition_kpis",
    "a2_knockout_analysis": "SELECT * FROM knockout_analysis",
    "a3_team_performance": "SELECT * FROM team_performance",
    "a4_team_strength_inputs": "SELECT * FROM team_strength_inputs",
    "a1_incremental_kpis": "SELECT * FROM edition_kpis",
    "a2_incremental_knockout": "SELECT * FROM knockout_analysis",
    "a3_incremental_performance": "SELECT * FROM team_performance",
    "a4_incremental_strength": "SELECT * FROM team_strength_inputs",
    "s1_csv_rejects": f"""
        SELECT CASE WHEN spoilt = '' THEN 'read' ELSE 'no value of its type: ' || spoilt END AS outcome, count(*) AS n
        FROM (SELECT concat_ws(', ', if(home_score + away_score >= 5, 'Date', NULL), if("Attendance" > 60000, 'Attendance', NULL)) AS spoilt
              FROM raw_matches WHERE "Year" IN ({SCOPE_YEARS}))
        GROUP BY outcome""",
    "s12_scalar": "SELECT year, count(*) / CAST((SELECT count(*) FROM stg_matches) AS DOUBLE) AS share, (SELECT count(*) FROM stg_matches) AS total FROM stg_matches GROUP BY year",
    "g3_data_dictionary": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", \"column\", n_known, (SELECT count(*) FROM {cte}) AS n_rows "
        f"FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {cte}) ON COLUMNS(*) INTO NAME \"column\" VALUE n_known)"
        for name, cte in (("mart.edition_kpis", "edition_kpis"), ("mart.team_performance", "team_performance"), ("mart.int_match_stages", "int_match_stages"),
                          ("mart.int_team_matches", "int_team_matches"), ("mart.knockout_analysis", "knockout_analysis"),
                          ("mart.ranking_vs_result", "ranking_vs_result"), ("predict.predictions", "predictions"))),
    "a6_filtered_counts": """
        SELECT year, 2 * count(*) AS team_matches, count(winner) AS won, count(winner) AS not_won,
               CAST(2 * sum(CAST(decided_on_pens AS INT)) AS BIGINT) AS on_pens
        FROM stg_matches GROUP BY year""",
    "j1_matches_edition": f"SELECT {MK}, w.champion, w.runner_up FROM stg_matches m, stg_world_cup w WHERE w.year = m.year".replace("SELECT year", "SELECT m.year"),
    "j2_reconcile_names": """
        SELECT DISTINCT ON (s) s AS team, coalesce((SELECT ranking_name FROM crosswalk WHERE match_name = s), s) AS ranking_name
        FROM (SELECT home_team AS s FROM stg_matches UNION SELECT away_team FROM stg_matches)""",
    "j3_side_ranks": f"SELECT {MK}, home_rank, away_rank FROM ranked_sides",
    # questions
    "q1_edition_kpis": "SELECT * FROM edition_kpis",
    "q2_top_attack": """
        SELECT * EXCLUDE (place) FROM (
            SELECT team, year, matches, goals_for, xg_for, attack_vs_xg,
                   row_number() OVER (ORDER BY attack_vs_xg DESC NULLS LAST, team, year) AS place
            FROM team_performance WHERE matches >= 4)
        WHERE place <= 8""",
    "q3_top_defense": """
        SELECT * EXCLUDE (place) FROM (
            SELECT team, year, matches, goals_against, xg_against, defense_vs_xg,
                   row_number() OVER (ORDER BY defense_vs_xg DESC NULLS LAST, team, year) AS place
            FROM team_performance WHERE matches >= 4)
        WHERE place <= 8""",
    "q4_knockout": "SELECT * EXCLUDE (stage_order) FROM knockout_analysis",
    "q5_favorite_by_phase": """
        SELECT phase, CAST(d AS BIGINT) AS decided, CAST(w AS BIGINT) AS favorite_won, round(100.0 * w / nullif(d, 0), 1) AS favorite_win_pct
        FROM (SELECT if(stage_order = 1, 'Group stage', 'Knockout') AS phase, sum(decided) AS d, sum(won) AS w
              FROM favourite_sums JOIN stage_list USING (round) GROUP BY phase)""",
    "d1_round_frequency": "SELECT round, count(*) AS n FROM stg_matches GROUP BY round",
    "d2_unranked_teams": f"SELECT team FROM (SELECT home_team AS team, year FROM stg_matches UNION SELECT away_team, year FROM stg_matches) p "
    f"ANTI JOIN (SELECT team FROM stg_rankings WHERE cycle = {TEST_CYCLE}) r USING (team) WHERE year = {TEST_YEAR}",
    "e1_team_performance": "SELECT * EXCLUDE (wins_reg, draws, losses_reg, advanced_or_won) FROM team_performance",
    "e2_efficiency_table": "SELECT * EXCLUDE (wins_reg, draws, losses_reg, advanced_or_won, goal_diff) FROM team_performance WHERE matches > 4",
}


# Raw tables and their columns, in file order, for the catalogue profile.
_RAW = {
    "matches": ("raw_matches", "Year Date Host Round Venue Attendance home_team away_team home_score away_score home_xg away_xg home_penalty away_penalty home_manager away_manager home_captain away_captain Referee Notes"),
    "world_cup": ("raw_world_cup", "Year Host Teams Champion Runner-Up TopScorrer Attendance AttendanceAvg Matches"),
    "schedule": ("raw_schedule", "Round Date home_team away_team Notes"),
    "ranking_old": ("raw_ranking_old", "team team_code association rank previous_rank points previous_points"),
    "ranking_new": ("raw_ranking_new", "team team_code association rank previous_rank points previous_points rated_matches"),
}


def _profile() -> str:
    parts = []
    for name, (relation, columns) in _RAW.items():
        cells = ", ".join(f"{{'c': '{c}', 't': typeof(any_value(\"{c}\"))}}" for c in columns.split())
        parts.append(f"SELECT '{name}' AS \"table\", count(*) AS n_rows, [{cells}] AS cells FROM {relation}")
    return f"""
        SELECT "table", CAST(i - 1 AS INTEGER) AS position, cells[i].c AS "column",
               CASE cells[i].t WHEN 'VARCHAR' THEN 'string' ELSE lower(cells[i].t) END AS type, n_rows
        FROM (SELECT *, unnest(range(1, len(cells) + 1)) AS i FROM ({" UNION ALL ".join(parts)}))"""


_ROUND_TRIPS: dict[str, str] = {
    "s1_csv_source": f'SELECT * FROM raw_matches WHERE "Year" IN ({SCOPE_YEARS})',
    "s3_replace_table": f'SELECT * FROM raw_world_cup WHERE "Year" IN ({SCOPE_YEARS})',
    "s4_catalog_profile": _profile(),
    "s7_csv_sink": "SELECT * FROM predictions",
    "s9_publish_snapshot": """
        SELECT 'team_performance' AS relation, count(*) AS n_rows FROM both_sums
        UNION ALL SELECT 'knockout_analysis', count(*) FROM knockout_analysis""",
    "s11_batch_job": "SELECT * FROM predictions",
}


def oracle_sql() -> dict[str, str]:
    from oracle import model  # noqa: I001  registers CTEs; order matters: dashboard reads model CTEs
    from oracle import dashboard

    bodies = {**_BODIES, **model.BODIES, **dashboard.BODIES, **_ROUND_TRIPS}
    return {name: with_ctes(body) for name, body in bodies.items()}
