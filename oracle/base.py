"""Common table expressions of the oracle: bridge, staging and marts.

``with_ctes(body)`` prepends every CTE; DuckDB only evaluates those the
body reaches.
"""

from __future__ import annotations

SCOPE_YEARS = "1998, 2000"
TRAIN_YEARS = "1998"
TEST_YEAR = 2000
TEST_CYCLE = 2000
PREDICT_CYCLE = 2002

BRIDGE = """
raw_matches AS (
    SELECT
        CAST(year(o.o_orderdate) AS BIGINT)                      AS "Year",
        CAST(o.o_orderdate AS DATE)                              AS "Date",
        'HOST_' || CAST(CAST(year(o.o_orderdate) AS BIGINT) AS VARCHAR) AS "Host",
        CASE l.l_linenumber
            WHEN 1 THEN 'Group stage' WHEN 2 THEN 'Group stage'
            WHEN 3 THEN 'Round of 16' WHEN 4 THEN 'Quarter-finals'
            WHEN 5 THEN 'Semi-finals' WHEN 6 THEN 'Third-place match'
            WHEN 7 THEN 'Final' END                              AS "Round",
        o.o_orderpriority                                        AS "Venue",
        CAST(floor(l.l_extendedprice) AS BIGINT)                 AS "Attendance",
        hn.n_name                                                AS home_team,
        an.n_name                                                AS away_team,
        CAST(l.l_quantity AS BIGINT) % 5                         AS home_score,
        l.l_partkey % 4                                          AS away_score,
        CASE WHEN l.l_tax < 0.08 THEN l.l_discount * 20 END      AS home_xg,
        CASE WHEN l.l_tax < 0.08 THEN l.l_tax * 25 END           AS away_xg,
        CAST(CASE WHEN l.l_linenumber >= 3 AND CAST(l.l_quantity AS BIGINT) % 5 = l.l_partkey % 4
                  THEN CASE WHEN (l.l_orderkey + l.l_linenumber) % 2 = 0 THEN 5 ELSE 3 END END AS BIGINT)
                                                                 AS home_penalty,
        CAST(CASE WHEN l.l_linenumber >= 3 AND CAST(l.l_quantity AS BIGINT) % 5 = l.l_partkey % 4
                  THEN 4 END AS BIGINT)                          AS away_penalty,
        c.c_name                                                 AS home_manager,
        s.s_name                                                 AS away_manager,
        CAST(NULL AS VARCHAR)                                    AS home_captain,
        CAST(NULL AS VARCHAR)                                    AS away_captain,
        'REF_' || CAST(l.l_orderkey % 97 AS VARCHAR)             AS "Referee",
        o.o_orderstatus                                          AS "Notes"
    FROM lineitem l
    JOIN orders o    ON l.l_orderkey = o.o_orderkey
    JOIN customer c  ON o.o_custkey = c.c_custkey
    JOIN nation hn   ON c.c_nationkey = hn.n_nationkey
    JOIN supplier s  ON l.l_suppkey = s.s_suppkey
    JOIN nation an   ON s.s_nationkey = an.n_nationkey
    WHERE c.c_nationkey <> s.s_nationkey
),
raw_world_cup AS (
    SELECT
        y                                                        AS "Year",
        'HOST_' || CAST(y AS VARCHAR)                            AS "Host",
        CAST(32 AS BIGINT)                                       AS "Teams",
        'NATION_' || CAST(y % 25 AS VARCHAR)                     AS "Champion",
        'NATION_' || CAST((y + 1) % 25 AS VARCHAR)               AS "Runner-Up",
        'NATION_' || CAST((y + 2) % 25 AS VARCHAR) || ' - ' || CAST(y % 7 + 3 AS VARCHAR) AS "TopScorrer",
        att                                                      AS "Attendance",
        att_avg                                                  AS "AttendanceAvg",
        n                                                        AS "Matches"
    FROM (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n,
               CAST(sum(floor(o_totalprice)) AS BIGINT) AS att, avg(floor(o_totalprice)) AS att_avg
        FROM orders GROUP BY 1
    )
),
raw_ranking_old AS (
    SELECT CASE WHEN n.n_nationkey < 3 THEN 'N' || CAST(n.n_nationkey AS VARCHAR) ELSE n.n_name END AS team,
           'T' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS team_code,
           r.r_name AS association,
           CAST((n.n_nationkey * 7) % 25 + 1 AS BIGINT) AS rank,
           CAST((n.n_nationkey * 3) % 25 + 1 AS BIGINT) AS previous_rank,
           CAST(1000 + n.n_nationkey * 30 AS DOUBLE) AS points,
           CAST(1000 + n.n_nationkey * 30 - 15 AS DOUBLE) AS previous_points
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT r_name, 'R' || CAST(r_regionkey AS VARCHAR), r_name,
           CAST(r_regionkey + 26 AS BIGINT), CAST(r_regionkey + 26 AS BIGINT),
           CAST(900 - r_regionkey * 10 AS DOUBLE), CAST(900 - r_regionkey * 10 AS DOUBLE)
    FROM region
),
raw_ranking_new AS (
    SELECT CASE WHEN n.n_nationkey < 3 THEN 'N' || CAST(n.n_nationkey AS VARCHAR) ELSE n.n_name END AS team,
           'T' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS team_code,
           r.r_name AS association,
           CAST((n.n_nationkey * 11) % 25 + 1 AS BIGINT) AS rank,
           CAST((n.n_nationkey * 7) % 25 + 1 AS BIGINT) AS previous_rank,
           CAST(1010 + ((n.n_nationkey * 13) % 25) * 28 AS DOUBLE) AS points,
           CAST(1000 + n.n_nationkey * 30 AS DOUBLE) AS previous_points,
           CAST(n.n_nationkey + 20 AS BIGINT) AS rated_matches
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT r_name, 'R' || CAST(r_regionkey AS VARCHAR), r_name,
           CAST(r_regionkey + 26 AS BIGINT), CAST(r_regionkey + 26 AS BIGINT),
           CAST(880 - r_regionkey * 12 AS DOUBLE), CAST(900 - r_regionkey * 10 AS DOUBLE),
           CAST(r_regionkey + 8 AS BIGINT)
    FROM region
),
raw_schedule AS (
    SELECT 'Group stage' AS "Round",
           CAST(DATE '2002-06-11' + CAST(n.n_nationkey % 14 AS INTEGER) AS DATE) AS "Date",
           n.n_name AS home_team, r.r_name AS away_team, CAST(NULL AS VARCHAR) AS "Notes"
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT 'Group stage',
           CAST(DATE '2002-06-11' + CAST((n.n_nationkey + 7) % 14 AS INTEGER) AS DATE),
           n.n_name, n2.n_name, CAST(NULL AS VARCHAR)
    FROM nation n JOIN nation n2 ON n2.n_nationkey = n.n_nationkey + 1
),
crosswalk(match_name, ranking_name) AS (
    VALUES ('NATION_0', 'N0'), ('NATION_1', 'N1'), ('NATION_2', 'N2')
)
"""

LAYERS = f"""
stage_list(round, stage_order) AS (
    SELECT DISTINCT "Round", CAST(stage AS INTEGER) FROM (
        SELECT unnest(['Group stage', 'Round of 16', 'Quarter-finals', 'Semi-finals', 'Third-place match', 'Final']) AS "Round",
               generate_subscripts(['Group stage', 'Round of 16', 'Quarter-finals', 'Semi-finals', 'Third-place match', 'Final'], 1) AS stage)
),
scoped AS (
    SELECT r.*, home_score - away_score AS margin,
           coalesce(home_penalty, 0) - coalesce(away_penalty, 0) AS pen_margin
    FROM raw_matches r SEMI JOIN (SELECT unnest([{SCOPE_YEARS}]) AS y) s ON r."Year" = s.y
),
stg_matches AS (
    SELECT "Year" AS year, "Date" AS match_date, "Host" AS host, "Round" AS round, "Venue" AS venue, "Attendance" AS attendance,
           home_team, away_team, home_score, away_score, home_xg, away_xg, home_penalty AS home_pens, away_penalty AS away_pens,
           home_manager, away_manager, home_captain, away_captain, "Referee" AS referee, "Notes" AS notes,
           margin + 2 * away_score AS total_goals,
           margin AS home_goal_diff,
           greatest(coalesce(home_penalty, 0), coalesce(away_penalty, 0)) > 0 AS decided_on_pens,
           (['away_win', 'draw', 'home_win'])[CAST(sign(margin) AS INTEGER) + 2] AS result_regulation,
           ([away_team, NULL, home_team])[CAST(coalesce(nullif(sign(margin), 0), sign(pen_margin)) AS INTEGER) + 2] AS winner,
           round((home_score - home_xg) + (away_score - away_xg), 2) AS goals_minus_xg
    FROM scoped
),
stg_world_cup AS (
    SELECT w."Year" AS year, w."Host" AS host, w."Teams" AS n_teams, w."Champion" AS champion, w."Runner-Up" AS runner_up,
           w."TopScorrer" AS top_scorer, w."Attendance" AS attendance_total, w."AttendanceAvg" AS attendance_avg, w."Matches" AS n_matches
    FROM (SELECT unnest([{SCOPE_YEARS}]) AS y) e JOIN raw_world_cup w ON w."Year" = e.y
),
stg_rankings AS (
    SELECT snapshot.* , t.* EXCLUDE (which) FROM (
        SELECT 'old' AS which, *, CAST(NULL AS BIGINT) AS rated_matches FROM raw_ranking_old
        UNION ALL BY NAME SELECT 'new' AS which, * FROM raw_ranking_new
    ) t JOIN LATERAL (
        SELECT CASE t.which WHEN 'old' THEN DATE '2000-10-06' ELSE DATE '2002-06-08' END AS snapshot_date,
               CASE t.which WHEN 'old' THEN 2000 ELSE 2002 END AS cycle
    ) snapshot ON TRUE
),
int_match_stages AS (
    SELECT m.*, if(s.stage_order = 1, 'group', 'knockout') AS stage_type, s.stage_order
    FROM stg_matches m LEFT JOIN stage_list s USING (round)
),
sides AS (
    -- a match as a list of two sides, spread by unnest
    SELECT unnest([
        {{'t': home_team, 'o': away_team, 'h': TRUE, 'gf': home_score, 'ga': away_score, 'xf': home_xg, 'xa': away_xg, 'pf': home_pens, 'pa': away_pens, 'd': margin}},
        {{'t': away_team, 'o': home_team, 'h': FALSE, 'gf': away_score, 'ga': home_score, 'xf': away_xg, 'xa': home_xg, 'pf': away_pens, 'pa': home_pens, 'd': -margin}}
    ]) AS s, year, match_date, round, host, decided_on_pens, winner
    FROM (SELECT *, home_goal_diff AS margin FROM stg_matches)
),
int_team_matches AS (
    SELECT year, match_date, round, host, s.t AS team, s.o AS opponent, s.h AS is_home, s.gf AS goals_for, s.ga AS goals_against,
           s.xf AS xg_for, s.xa AS xg_against, s.pf AS pens_for, s.pa AS pens_against, decided_on_pens,
           (['loss', 'draw', 'win'])[CAST(sign(s.d) AS INTEGER) + 2] AS result,
           winner = s.t AS won_match
    FROM sides
),
home_sums AS (
    SELECT home_team AS team, year, count(*) AS n, sum(CAST(margin > 0 AS INT)) AS w, sum(CAST(margin = 0 AS INT)) AS d,
           sum(CAST(winner IS NOT DISTINCT FROM home_team AS INT)) AS v, sum(home_score) AS gf, sum(away_score) AS ga, sum(home_xg) AS xf, sum(away_xg) AS xa
    FROM (SELECT *, home_goal_diff AS margin FROM stg_matches) GROUP BY ALL
),
away_sums AS (
    SELECT away_team AS team, year, count(*) AS n, sum(CAST(margin < 0 AS INT)) AS w, sum(CAST(margin = 0 AS INT)) AS d,
           sum(CAST(winner IS NOT DISTINCT FROM away_team AS INT)) AS v, sum(away_score) AS gf, sum(home_score) AS ga, sum(away_xg) AS xf, sum(home_xg) AS xa
    FROM (SELECT *, home_goal_diff AS margin FROM stg_matches) GROUP BY ALL
),
both_sums AS (
    SELECT team, year, sum(COLUMNS(* EXCLUDE (team, year))) FROM (SELECT * FROM home_sums UNION ALL SELECT * FROM away_sums) GROUP BY team, year
),
team_performance AS (
    SELECT team, year, CAST(n AS BIGINT) AS matches, CAST(w AS BIGINT) AS wins_reg, CAST(d AS BIGINT) AS draws, CAST(n - w - d AS BIGINT) AS losses_reg,
           CAST(v AS BIGINT) AS advanced_or_won, CAST(gf AS BIGINT) AS goals_for, CAST(ga AS BIGINT) AS goals_against, CAST(gf - ga AS BIGINT) AS goal_diff,
           round(xf, 2) AS xg_for, round(xa, 2) AS xg_against, round(gf - xf, 2) AS attack_vs_xg, round(xa - ga, 2) AS defense_vs_xg
    FROM both_sums
),
team_strength_inputs AS (
    SELECT team, CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(goals_for) AS BIGINT) AS goals_for,
           CAST(sum(goals_against) AS BIGINT) AS goals_against, sum(xg_for) AS xg_for, sum(xg_against) AS xg_against
    FROM team_performance GROUP BY team
),
year_sums AS (
    SELECT year, min(host) AS host, count(*) AS n, sum(total_goals) AS goals, count(home_xg + away_xg) AS n_xg, sum(home_xg + away_xg) AS xg,
           sum(CAST(decided_on_pens AS INT)) AS pens, avg(attendance) AS att
    FROM stg_matches GROUP BY year
),
edition_kpis AS (
    SELECT y.year, y.host, n AS n_matches, CAST(goals AS BIGINT) AS total_goals, round(goals / n, 2) AS goals_per_match,
           round(xg / n_xg, 2) AS xg_per_match, round(goals / n - xg / n_xg, 2) AS goals_minus_xg, CAST(pens AS BIGINT) AS pen_shootouts,
           round(att) AS avg_attendance, w.champion, w.runner_up, w.top_scorer
    FROM year_sums y LEFT JOIN stg_world_cup w ON w.year = y.year
),
knockout_analysis AS (
    SELECT k.year, k.round, s.stage_order, k.n AS n_matches, round(k.goals / k.n, 2) AS goals_per_match, round(k.xg / k.n_xg, 2) AS xg_per_match,
           CAST(k.pens AS BIGINT) AS pen_shootouts
    FROM (SELECT year, round, count(*) AS n, sum(total_goals) AS goals, count(home_xg + away_xg) AS n_xg, sum(home_xg + away_xg) AS xg,
                 sum(CAST(decided_on_pens AS INT)) AS pens FROM stg_matches GROUP BY year, round) k
    JOIN stage_list s ON s.round = k.round AND s.stage_order > 1
),
rank_of AS (
    -- ranks of the test cycle under the names that matches use
    SELECT coalesce(c.match_name, r.team) AS name, r.rank
    FROM stg_rankings r LEFT JOIN crosswalk c ON c.ranking_name = r.team WHERE r.cycle = {TEST_CYCLE}
),
ranked_sides AS (
    SELECT m.*, h.rank AS home_rank, a.rank AS away_rank
    FROM stg_matches m LEFT JOIN rank_of h ON h.name = m.home_team LEFT JOIN rank_of a ON a.name = m.away_team
),
ranking_vs_result AS (
    SELECT round, home_team, away_team, home_rank, away_rank, winner, if(home_first, home_team, away_team) AS higher_ranked,
           if(winner IS NULL, NULL, home_rank IS NOT NULL AND away_rank IS NOT NULL AND home_rank <> away_rank AND winner = if(home_first, home_team, away_team)) AS favorite_won
    FROM (SELECT *, coalesce(home_rank < away_rank, FALSE) AS home_first FROM ranked_sides WHERE year = {TEST_YEAR})
),
favourite_sums AS (
    -- decided matches and those the better-ranked side won, per round
    SELECT round, count(favorite_won) AS decided, coalesce(sum(CAST(favorite_won AS INT)), 0) AS won FROM ranking_vs_result GROUP BY round
)
"""

_EXTRA: list[str] = []


def register_ctes(text: str) -> None:
    """Add more CTEs (model, evaluation) after the layers."""
    _EXTRA.append(text.strip().rstrip(","))


def with_ctes(body: str) -> str:
    ctes = [BRIDGE.strip(), LAYERS.strip(), *_EXTRA]
    return "WITH " + ",\n".join(ctes) + "\n" + body
