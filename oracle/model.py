"""Oracle SQL of the model and the back-test.

The CTE templates below are instantiated per (statistics, grid, team
universe, ranking cycle); scoring is the brute-force 9 x 9 score grid.
"""

from __future__ import annotations

from oracle.base import PREDICT_CYCLE, TEST_CYCLE, TEST_YEAR, TRAIN_YEARS, register_ctes

K_GRID = (1.0, 2.0, 3.0, 5.0, 8.0)
W_GRID = (0.0, 0.25, 0.5, 0.75, 1.0)


def _grid_values(points) -> str:
    return ", ".join(f"({k!r}E0, {w!r}E0)" for k, w in points)


def _strength_ctes(p: str, stats: str, grid: str, universe: str, cycle: int) -> str:
    m = "CAST(s.matches AS DOUBLE)"
    blend_for = "(l.w * CAST(s.goals_for AS DOUBLE) + (1.0E0 - l.w) * s.xg_for)"
    blend_against = "(l.w * CAST(s.goals_against AS DOUBLE) + (1.0E0 - l.w) * s.xg_against)"
    return f"""
{p}_league AS (
    SELECT g.k, g.w, (g.w * CAST(t.sg AS DOUBLE) + (1.0E0 - g.w) * CAST(t.sx AS DOUBLE)) / CAST(t.sm AS DOUBLE) AS league_avg
    FROM {grid} g, (SELECT sum(goals_for) AS sg, sum(xg_for) AS sx, sum(matches) AS sm FROM {stats}) t
),
{p}_strength AS (
    SELECT s.team, l.k, l.w, s.matches,
        ({m} * ({blend_for} / {m} / l.league_avg) + l.k) / ({m} + l.k) AS attack,
        ({m} * ({blend_against} / {m} / l.league_avg) + l.k) / ({m} + l.k) AS defense
    FROM {stats} s, {p}_league l
),
{p}_rank AS (
    SELECT t.team, r.rank, r.points
    FROM {universe} t
    LEFT JOIN crosswalk c ON c.match_name = t.team
    LEFT JOIN stg_rankings r ON r.team = COALESCE(c.ranking_name, t.team) AND r.cycle = {cycle}
),
{p}_feat AS (
    SELECT r.team, g.k, g.w, r.rank, r.points, s.matches, s.attack, s.defense,
           s.matches IS NOT NULL AS has_history
    FROM {p}_rank r CROSS JOIN {grid} g
    LEFT JOIN {p}_strength s ON s.team = r.team AND s.k = g.k AND s.w = g.w
),
{p}_fit AS (
    SELECT k, w,
        regr_intercept(attack, points) AS attack_intercept, regr_slope(attack, points) AS attack_slope,
        regr_intercept(defense, points) AS defense_intercept, regr_slope(defense, points) AS defense_slope
    FROM {p}_feat WHERE attack IS NOT NULL AND points IS NOT NULL GROUP BY k, w
),
{p}_full AS (
    SELECT f.team, f.k, f.w, f.rank, f.points, f.matches,
        COALESCE(f.attack, CASE WHEN f.points IS NOT NULL
            THEN least(greatest(x.attack_intercept + x.attack_slope * f.points, 0.4E0), 1.6E0) END) AS attack,
        COALESCE(f.defense, CASE WHEN f.points IS NOT NULL
            THEN least(greatest(x.defense_intercept + x.defense_slope * f.points, 0.5E0), 2.0E0) END) AS defense,
        f.has_history
    FROM {p}_feat f LEFT JOIN {p}_fit x ON x.k = f.k AND x.w = f.w
)"""


def _score_ctes(name: str, pairs: str, mp: str, grid: str) -> str:
    pmf = "exp(-{mu}) * pow({mu}, {g}) / CAST(factorial(CAST({g} AS INTEGER)) AS DOUBLE)"
    return f"""
{name}_mu AS (
    SELECT q.*, g.k, g.w,
        h.attack AS attack_home, h.defense AS defense_home, a.attack AS attack_away, a.defense AS defense_away,
        l.league_avg * h.attack * a.defense AS mu_home,
        l.league_avg * a.attack * h.defense AS mu_away
    FROM {pairs} q CROSS JOIN {grid} g
    LEFT JOIN {mp}_full h ON h.team = q.home_team AND h.k = g.k AND h.w = g.w
    LEFT JOIN {mp}_full a ON a.team = q.away_team AND a.k = g.k AND a.w = g.w
    LEFT JOIN {mp}_league l ON l.k = g.k AND l.w = g.w
),
{name}_cells AS (
    SELECT m.home_team, m.away_team, m.k, m.w, i.gi, j.gj,
        ({pmf.format(mu="m.mu_home", g="i.gi")}) * ({pmf.format(mu="m.mu_away", g="j.gj")}) AS joint
    FROM {name}_mu m, range(0, 9) AS i(gi), range(0, 9) AS j(gj)
),
{name}_probs AS (
    SELECT home_team, away_team, k, w,
        sum(joint) FILTER (WHERE gi > gj) / sum(joint) AS prob_home_win,
        sum(joint) FILTER (WHERE gi = gj) / sum(joint) AS prob_draw,
        sum(joint) FILTER (WHERE gi < gj) / sum(joint) AS prob_away_win
    FROM {name}_cells GROUP BY home_team, away_team, k, w
),
{name} AS (
    SELECT m.*, p.prob_home_win, p.prob_draw, p.prob_away_win
    FROM {name}_mu m LEFT JOIN {name}_probs p USING (home_team, away_team, k, w)
)"""


_ARGMAX = (
    "CASE WHEN {h} >= {d} AND {h} >= {a} THEN 'home_win' WHEN {d} >= {a} THEN 'draw' ELSE 'away_win' END"
)
MATCH_ORDER = (
    "year", "match_date", "host", "round", "venue", "attendance", "home_team", "away_team",
    "home_score", "away_score", "home_xg", "away_xg", "home_pens", "away_pens",
    "home_manager", "away_manager", "home_captain", "away_captain", "referee", "notes",
)
METRICS = ("model_acc", "model_ll", "naive_acc", "naive_ll", "favorite_acc")
def _mix_layers(src: str, col: str, keep: str) -> str:
    """Nested selects: two multiply-xorshift rounds and a final xorshift of ``col``."""
    for _ in range(2):
        src = f"(SELECT {keep}, ((xor({col} >> 16, {col}) * 73244475) & 4294967295) AS {col} FROM {src})"
    return f"(SELECT {keep}, xor({col} >> 16, {col}) AS {col} FROM {src})"


def _hash_sql(src: str, keep: str, seed: int) -> str:
    """``src`` has b and d; adds u, the 63-bit hash of (seed, b, d)."""
    keep = f"b, d, {keep}" if keep else "b, d"
    src = _mix_layers(f"(SELECT {keep}, xor(CAST({seed} AS BIGINT), b & 4294967295) AS h FROM {src})", "h", keep)
    src = _mix_layers(f"(SELECT {keep}, xor(h, d & 4294967295) AS h FROM {src})", "h", keep)
    src = _mix_layers(f"(SELECT {keep}, xor(h, d >> 32) AS h FROM {src})", "h", keep)
    src = _mix_layers(f"(SELECT {keep}, h, xor(h, 2654435769) AS hi FROM {src})", "hi", keep + ", h")
    return f"(SELECT {keep}, (hi & 2147483647) * 4294967296 + h AS u FROM {src})"


def _draws_sql(n: str, resamples: int, seed: int) -> str:
    """Draw d of resample b is the rank hash(seed, b, d) mod n."""
    src = f"(SELECT r.b, i.d FROM range(0, {resamples}) AS r(b), (SELECT unnest(range(0, n)) AS d FROM {n}) i)"
    return f"SELECT b, u % (SELECT n FROM {n}) AS pick FROM {_hash_sql(src, '', seed)}"


def _poisson_sql(rows: str, resamples: int, seed: int) -> str:
    import math

    cdf, term = [math.exp(-1.0)], 1
    while cdf[-1] + math.exp(-1.0) / math.factorial(term) != cdf[-1]:
        cdf.append(cdf[-1] + math.exp(-1.0) / math.factorial(term))
        term += 1
    hashed = _hash_sql(f"(SELECT r.b, i.row_key AS d, {', '.join(METRICS)} FROM {rows} i, range(0, {resamples}) AS r(b))", ", ".join(METRICS), seed)
    w = " + ".join(f"CAST(u >= {c!r} AS INTEGER)" for c in cdf)
    return f"SELECT b, {', '.join(METRICS)}, {w} AS w FROM (SELECT * REPLACE (CAST(u AS DOUBLE) / 9223372036854775808.0 AS u) FROM {hashed})"


_HASH_TEXT = "concat_ws('|', " + ", ".join(
    f"CAST(CAST(floor({c} * 1000000 + 0.5) AS BIGINT) AS VARCHAR)" if c in ("home_xg", "away_xg") else f"CAST({c} AS VARCHAR)" for c in MATCH_ORDER
) + ")"

register_ctes(
    f"""
grid1(k, w) AS (VALUES (3.0E0, 0.5E0)),
grid25(k, w) AS (VALUES {_grid_values([(k, w) for k in K_GRID for w in W_GRID])}),
pooled_stats AS (SELECT team, matches, goals_for, goals_against, xg_for, xg_against FROM team_strength_inputs),
train_stats AS (
    SELECT team, count(*) AS matches, CAST(sum(goals_for) AS BIGINT) AS goals_for,
           CAST(sum(goals_against) AS BIGINT) AS goals_against, sum(xg_for) AS xg_for, sum(xg_against) AS xg_against
    FROM int_team_matches WHERE year IN ({TRAIN_YEARS}) GROUP BY team
),
schedule_teams AS (SELECT home_team AS team FROM raw_schedule UNION SELECT away_team FROM raw_schedule),
test_teams AS (SELECT DISTINCT team FROM int_team_matches WHERE year = {TEST_YEAR}),
{_strength_ctes("pm", "pooled_stats", "grid1", "schedule_teams", PREDICT_CYCLE)},
{_strength_ctes("bt", "train_stats", "grid1", "test_teams", TEST_CYCLE)},
{_strength_ctes("sw", "train_stats", "grid25", "test_teams", TEST_CYCLE)},
sched AS (SELECT "Round" AS round, "Date" AS date, home_team, away_team FROM raw_schedule),
{_score_ctes("pm_sc", "sched", "pm", "grid1")},
test_m AS (SELECT * FROM int_match_stages WHERE year = {TEST_YEAR}),
test_pairs AS (SELECT DISTINCT home_team, away_team FROM test_m),
{_score_ctes("bt_sc", "test_pairs", "bt", "grid1")},
{_score_ctes("sw_sc", "test_pairs", "sw", "grid25")},
predictions AS (
    SELECT round, date, home_team, away_team,
        round(mu_home, 3) AS expected_home_goals, round(mu_away, 3) AS expected_away_goals,
        round(prob_home_win, 4) AS prob_home_win, round(prob_draw, 4) AS prob_draw,
        round(prob_away_win, 4) AS prob_away_win
    FROM pm_sc
),
naive_shares AS (
    SELECT CAST(count(*) FILTER (WHERE result_regulation = 'home_win') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS hw,
           CAST(count(*) FILTER (WHERE result_regulation = 'draw') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS dr,
           CAST(count(*) FILTER (WHERE result_regulation = 'away_win') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS aw
    FROM int_match_stages WHERE year IN ({TRAIN_YEARS})
),
naive AS (
    SELECT 'home_win' AS outcome, hw AS share, {_ARGMAX.format(h="hw", d="dr", a="aw")} = 'home_win' AS is_predicted FROM naive_shares
    UNION ALL
    SELECT 'draw', dr, {_ARGMAX.format(h="hw", d="dr", a="aw")} = 'draw' FROM naive_shares
    UNION ALL
    SELECT 'away_win', aw, {_ARGMAX.format(h="hw", d="dr", a="aw")} = 'away_win' FROM naive_shares
),
bt_per_match AS (
    SELECT z.*,
        CAST(predicted = actual AS DOUBLE) AS model_acc,
        -ln(greatest(CASE actual WHEN 'home_win' THEN prob_home_win WHEN 'draw' THEN prob_draw
                                 WHEN 'away_win' THEN prob_away_win END, 1e-12)) AS model_ll,
        CAST(naive_hit AS DOUBLE) AS naive_acc,
        -ln(greatest(naive_p, 1e-12)) AS naive_ll,
        CAST(favorite_pred = actual AS DOUBLE) AS favorite_acc
    FROM (
        SELECT {", ".join("t." + c for c in MATCH_ORDER)}, t.result_regulation AS actual,
            s.prob_home_win, s.prob_draw, s.prob_away_win,
            {_ARGMAX.format(h="s.prob_home_win", d="s.prob_draw", a="s.prob_away_win")} AS predicted,
            CASE WHEN rh.rank < ra.rank THEN 'home_win' ELSE 'away_win' END AS favorite_pred,
            n.share AS naive_p, n.is_predicted AS naive_hit
        FROM test_m t
        LEFT JOIN bt_sc s ON s.home_team = t.home_team AND s.away_team = t.away_team
        LEFT JOIN bt_rank rh ON rh.team = t.home_team
        LEFT JOIN bt_rank ra ON ra.team = t.away_team
        LEFT JOIN naive n ON n.outcome = t.result_regulation
    ) z
),
bt_classes AS (
    SELECT home_team, away_team, actual, count(*) AS n, {", ".join(f"any_value({m}) AS {m}" for m in METRICS)} FROM bt_per_match GROUP BY home_team, away_team, actual
),
bt_ranges AS (
    SELECT *, sum(n) OVER (ORDER BY CAST(('0x' || substr(md5(concat_ws('|', home_team, away_team, actual)), 1, 8)) AS BIGINT), home_team, away_team, actual) - n AS first_rank
    FROM bt_classes
),
bt_ranked AS (SELECT CAST(first_rank AS BIGINT) + unnest(range(0, n)) AS rank, {", ".join(METRICS)} FROM bt_ranges),
bt_n AS (SELECT count(*) AS n FROM bt_per_match),
bt_draws AS ({_draws_sql("bt_n", 1000, 12345)}),
bt_means AS (
    SELECT d.b, {", ".join(f"avg(x.{m}) AS {m}" for m in METRICS)}
    FROM bt_draws d JOIN bt_ranked x ON x.rank = d.pick GROUP BY d.b
),
bt_ci AS (
    {" UNION ALL ".join(f"SELECT '{m}' AS key, quantile_cont({m}, 0.05) AS ci_lo, quantile_cont({m}, 0.95) AS ci_hi FROM bt_means" for m in METRICS)}
),
bt_point AS (
    SELECT * FROM (VALUES ('poisson', 'accuracy', 'model_acc'), ('poisson', 'log_loss', 'model_ll'),
                          ('naive', 'accuracy', 'naive_acc'), ('naive', 'log_loss', 'naive_ll'),
                          ('favorite', 'accuracy', 'favorite_acc')) AS v(model, metric, key)
),
bt_means_all AS (SELECT {", ".join(f"avg({m}) AS {m}" for m in METRICS)} FROM bt_per_match),
backtest AS (
    SELECT p.model, p.metric,
        round(CASE p.key {" ".join(f"WHEN '{m}' THEN a.{m}" for m in METRICS)} END, 6) AS value,
        round(c.ci_lo, 6) AS ci_lo, round(c.ci_hi, 6) AS ci_hi
    FROM bt_point p CROSS JOIN bt_means_all a JOIN bt_ci c ON c.key = p.key
),
bt_copies AS (
    SELECT *, {_HASH_TEXT} AS line, row_number() OVER (PARTITION BY {", ".join(MATCH_ORDER)}) - 1 AS copy FROM bt_per_match
),
bt_keyed AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', line, copy)), 1, 15)) AS BIGINT) AS row_key FROM bt_copies),
bt_pw AS ({_poisson_sql("bt_keyed", 1000, 12345)}),
bt_pmeans AS (
    SELECT b, {", ".join(f"sum(w * {m}) / nullif(sum(w) FILTER ({m} IS NOT NULL), 0) AS {m}" for m in METRICS)} FROM bt_pw GROUP BY b
),
bt_pci AS (
    {" UNION ALL ".join(f"SELECT '{m}' AS key, quantile_cont({m}, 0.05) AS ci_lo, quantile_cont({m}, 0.95) AS ci_hi FROM bt_pmeans" for m in METRICS)}
),
backtest_poisson AS (
    SELECT p.model, p.metric,
        round(CASE p.key {" ".join(f"WHEN '{m}' THEN a.{m}" for m in METRICS)} END, 6) AS value,
        round(c.ci_lo, 6) AS ci_lo, round(c.ci_hi, 6) AS ci_hi
    FROM bt_point p CROSS JOIN bt_means_all a JOIN bt_pci c ON c.key = p.key
),
sw_counts AS (
    SELECT home_team, away_team, result_regulation AS actual, count(*) AS n FROM test_m GROUP BY ALL
),
sweep AS (
    SELECT s.k, s.w AS blend_weight,
        round(sum(c.n * CAST({_ARGMAX.format(h="s.prob_home_win", d="s.prob_draw", a="s.prob_away_win")} = c.actual AS DOUBLE))
              / CAST(sum(c.n) AS DOUBLE), 6) AS accuracy,
        round(sum(c.n * -ln(greatest(CASE c.actual WHEN 'home_win' THEN s.prob_home_win WHEN 'draw' THEN s.prob_draw
                                                   WHEN 'away_win' THEN s.prob_away_win END, 1e-12)))
              / CAST(sum(c.n) AS DOUBLE), 6) AS log_loss,
        s.k = 3.0 AND s.w = 0.5 AS is_default
    FROM sw_sc s JOIN sw_counts c ON c.home_team = s.home_team AND c.away_team = s.away_team
    GROUP BY s.k, s.w
)
"""
)

MK = "year, match_date, round, home_team, away_team"

BODIES: dict[str, str] = {
    "a5_team_stats_scoped": "SELECT * FROM train_stats",
    "a14_league_average": "SELECT k, w, league_avg, 'pooled' AS scope FROM pm_league UNION ALL SELECT k, w, league_avg, 'train' FROM bt_league",
    "m1_strength_pooled": "SELECT * FROM pm_strength",
    "m2_strength_train": "SELECT * FROM bt_strength",
    "u4_schedule_teams": "SELECT * FROM schedule_teams",
    "u5_edition_teams": "SELECT * FROM test_teams",
    "m3_team_rankings": "SELECT * FROM pm_rank",
    "j4_test_rankings": "SELECT * FROM bt_rank",
    "m4_team_features": "SELECT * FROM pm_feat",
    "m5_fallback_fit": "SELECT * FROM pm_fit",
    "m6_apply_fallback": "SELECT * FROM pm_full",
    "j6_schedule_strength": "SELECT round, date, home_team, away_team, attack_home, defense_home, attack_away, defense_away FROM pm_sc",
    "m9_outcome_probs": "SELECT home_team, away_team, mu_home, mu_away, prob_home_win, prob_draw, prob_away_win FROM bt_sc",
    "m10_predictions": "SELECT * FROM predictions ORDER BY date, home_team, away_team",
    "a20_prob_sum_check": """
        SELECT count(*) AS n_fixtures,
               round(min(prob_home_win + prob_draw + prob_away_win), 4) AS min_prob_sum,
               round(max(prob_home_win + prob_draw + prob_away_win), 4) AS max_prob_sum,
               count(*) FILTER (WHERE prob_home_win IS NULL) AS unscored
        FROM predictions""",
    "m11_predicted_label": f"SELECT {MK}, actual, predicted FROM bt_per_match",
    "m12_favorite_label": f"SELECT {MK}, actual, favorite_pred FROM bt_per_match",
    "m13_scored_test_matches": f"""
        SELECT {MK}, home_score, away_score, actual, prob_home_win, prob_draw, prob_away_win,
               predicted, favorite_pred, {", ".join(METRICS)} FROM bt_per_match""",
    "a16_naive_baseline": "SELECT * FROM naive",
    "a17_accuracy": "SELECT round(avg(model_acc), 6) AS model_acc, round(avg(naive_acc), 6) AS naive_acc, round(avg(favorite_acc), 6) AS favorite_acc FROM bt_per_match",
    "a18_log_loss": "SELECT round(avg(model_ll), 6) AS model_ll, round(avg(naive_ll), 6) AS naive_ll FROM bt_per_match",
    "m14_backtest": "SELECT * FROM backtest ORDER BY model, metric",
    "m15_bootstrap_poisson": "SELECT * FROM backtest_poisson ORDER BY model, metric",
    "m16_sweep": "SELECT * FROM sweep ORDER BY log_loss, k, blend_weight",
}
