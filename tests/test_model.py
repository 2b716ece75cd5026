"""Invariants of the strength model and the Poisson grid (tiny hand-made frames)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pitchside import config
from pitchside.functions.columns import poisson_pmf
from pitchside.operators import model


def _probs(spark, pairs):
    df = spark.createDataFrame(pairs, "mu_home double, mu_away double")
    return [tuple(r) for r in model.outcome_probs(df).select("prob_home_win", "prob_draw", "prob_away_win").collect()]


@pytest.mark.parametrize("mu", [0.01, 0.9, 2.3])
def test_poisson_pmf_has_the_right_moments(spark, mu):
    df = spark.range(40).select(F.col("id").alias("n"), poisson_pmf(F.col("id").cast("int"), F.lit(mu)).alias("p"))
    total, mean, square = df.agg(F.sum("p"), F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * F.col("n") * F.col("p"))).first()
    assert (total, mean, square - mean**2) == pytest.approx((1.0, mu, mu), abs=1e-9)


def test_outcome_probs_swap_with_the_sides(spark):
    (h, d, a), (h2, d2, a2) = _probs(spark, [(2.1, 0.6), (0.6, 2.1)])
    assert (h, d, a) == pytest.approx((a2, d2, h2), abs=1e-12)


def test_outcome_probs_move_with_the_means(spark):
    got = _probs(spark, [(0.4 + 0.3 * i, 1.1) for i in range(6)])
    assert [g[0] for g in got] == sorted(g[0] for g in got) and [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
    assert all(sum(g) == pytest.approx(1.0, abs=1e-12) for g in got)


def _grid_reference(mu_h, mu_a, g=config.MAX_GOALS):
    ph = [math.exp(-mu_h) * mu_h**k / math.factorial(k) for k in range(g + 1)]
    pa = [math.exp(-mu_a) * mu_a**k / math.factorial(k) for k in range(g + 1)]
    hw = sum(ph[i] * pa[j] for i in range(g + 1) for j in range(g + 1) if i > j)
    dr = sum(ph[i] * pa[i] for i in range(g + 1))
    aw = sum(ph[i] * pa[j] for i in range(g + 1) for j in range(g + 1) if i < j)
    t = hw + dr + aw
    return hw / t, dr / t, aw / t


@pytest.mark.parametrize("pair", [(1.5, 1.5), (2.5, 0.8), (0.0, 1.2), (4.0, 0.3), (0.7, 3.1)])
def test_outcome_probs_match_nested_loop(spark, pair):
    got = _probs(spark, [pair])[0]
    want = _grid_reference(*pair)
    assert got == pytest.approx(want, abs=1e-15)


def _stats(spark, rows):
    return spark.createDataFrame(
        rows, "team string, matches double, goals_for double, goals_against double, xg_for double, xg_against double"
    )


def _attack(spark, rows, k, w, league=1.25):
    return {r["team"]: r["attack"] for r in model.strength_from_stats(_stats(spark, rows), league, k, w).collect()}


def test_strength_nears_the_mean_as_k_grows(spark):
    row = [("A", 7.0, 16.0, 5.0, 13.0, 6.0)]
    gaps = [abs(_attack(spark, row, float(k), 0.5)["A"] - 1.0) for k in (0, 1, 4, 20, 1e9)]
    assert gaps == sorted(gaps, reverse=True) and gaps[-1] < 1e-6


def test_strength_keeps_its_rate_with_many_matches(spark):
    rows = [(f"n{n}", float(n), 2.0 * n, 1.0 * n, 2.0 * n, 1.0 * n) for n in (2, 20, 2_000_000)]
    got = _attack(spark, rows, 6.0, 0.3)
    assert got["n2"] < got["n20"] < got["n2000000"] == pytest.approx(2.0 / 1.25, abs=1e-4)


def test_strength_has_no_unit(spark):
    row = [("A", 5.0, 9.0, 4.0, 7.5, 5.5)]
    scaled = [("A", 5.0, 27.0, 12.0, 22.5, 16.5)]
    assert _attack(spark, row, 2.0, 0.7)["A"] == pytest.approx(_attack(spark, scaled, 2.0, 0.7, league=3.75)["A"])


def test_blend_is_linear_between_goals_and_xg(spark):
    row = [("A", 4.0, 10.0, 4.0, 6.0, 4.0)]
    ends = [_attack(spark, row, 3.0, w)["A"] for w in (0.0, 1.0)]
    for w in (0.2, 0.65):
        assert _attack(spark, row, 3.0, w)["A"] == pytest.approx((1 - w) * ends[0] + w * ends[1])


def _features(spark, rows):
    return spark.createDataFrame(rows, "team string, k double, w double, points double, attack double, defense double")


def test_fit_is_the_least_squares_line(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    pts = rng.uniform(700, 1700, 12)
    attack, defense = 0.2 + 7e-4 * pts + rng.normal(0, 0.05, 12), 1.9 - 6e-4 * pts + rng.normal(0, 0.05, 12)
    rows = [(f"x{i}", 2.0, 0.1, float(p), float(a), float(d)) for i, (p, a, d) in enumerate(zip(pts, attack, defense))]
    rows += [("no_points", 2.0, 0.1, None, 9.0, 9.0), ("no_history", 2.0, 0.1, 1200.0, None, None)]  # take no part
    fit = model.fit_fallback(_features(spark, rows)).first()
    for name, y in (("attack", attack), ("defense", defense)):
        slope, intercept = np.polyfit(pts, y, 1)
        assert (fit[f"{name}_slope"], fit[f"{name}_intercept"]) == pytest.approx((slope, intercept), rel=1e-8)


def _fit(spark, ai, asl, di, dsl):
    return spark.createDataFrame(
        [(3.0, 0.5, ai, asl, di, dsl)],
        "k double, w double, attack_intercept double, attack_slope double, defense_intercept double, defense_slope double",
    )


def _filled(spark, rows, *line):
    return {r["team"]: (r["attack"], r["defense"]) for r in model.apply_fallback(_features(spark, rows), _fit(spark, *line)).collect()}


def test_fallback_fills_each_gap_on_its_own(spark):
    line = (0.31, 4e-4, 1.72, -5e-4)
    got = _filled(spark, [("whole", 3.0, 0.5, 1111.0, 0.77, 1.23), ("attack_gap", 3.0, 0.5, 1111.0, None, 1.23), ("none", 3.0, 0.5, 1111.0, None, None), ("unranked", 3.0, 0.5, None, None, 0.6)], *line)
    a, d = 0.31 + 4e-4 * 1111, 1.72 - 5e-4 * 1111
    assert got["whole"] == (0.77, 1.23) and got["attack_gap"] == pytest.approx((a, 1.23)) and got["none"] == pytest.approx((a, d))
    assert got["unranked"] == (None, 0.6)


def test_fallback_is_clipped_at_both_ends_but_history_is_not(spark):
    got = _filled(spark, [("far_up", 3.0, 0.5, 9e4, None, None), ("far_down", 3.0, 0.5, -9e4, None, None), ("history", 3.0, 0.5, 9e4, 7.0, 0.01)], 0.9, 1e-3, 0.9, 1e-3)
    assert got["far_up"] == (config.ATTACK_CLIP[1], config.DEFENSE_CLIP[1]) and got["far_down"] == (config.ATTACK_CLIP[0], config.DEFENSE_CLIP[0])
    assert got["history"] == (7.0, 0.01)


def test_grid_fans_out_without_join(spark):
    df = spark.range(3).toDF("team")
    fanned = model.with_grid(df, model.sweep_grid())
    assert fanned.count() == 3 * 25
    plan = fanned._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_outcome_probs_stay_in_codegen(spark):
    """No arrays or lambdas: the grid is plain arithmetic inside whole-stage codegen."""
    df = spark.createDataFrame([(1.0, 2.0), (0.3, 0.0)], "mu_home double, mu_away double")
    out = model.outcome_probs(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "transform(" not in plan
    for r in out.collect():
        assert r["prob_home_win"] + r["prob_draw"] + r["prob_away_win"] == pytest.approx(1.0)
