"""Column helpers: built-in expressions only, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchside import config


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the binary value (scale, round, unscale).

    ``F.round`` rounds the shortest decimal text of a double, so 2.675 gives
    2.68 there; scaling first gives 2.67, which is what the SQL engines of the
    reference and of the oracle return."""
    c = col(c)
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clip keeping NULL as NULL (``least``/``greatest`` would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def stage_order(round_col: Column | str, stages: tuple[tuple[str, int], ...] = config.STAGE_ORDER) -> Column:
    """Chronological order of a stage name; unknown or NULL names give NULL."""
    r = col(round_col)
    expr = None
    for name, order in stages:
        expr = F.when(r == name, F.lit(order)) if expr is None else expr.when(r == name, F.lit(order))
    return expr


def stage_type(round_col: Column | str, group_stage: str = config.GROUP_STAGE) -> Column:
    """'group' iff the round is the group stage; anything else (NULL too) is knockout."""
    return F.when(col(round_col) == group_stage, F.lit("group")).otherwise(F.lit("knockout"))


def rate_pct(hits: Column, total: Column, digits: int = 1) -> Column:
    """round(100 * hits / total, digits), NULL when total is 0 (double arithmetic)."""
    return round_half_away(F.lit(100.0) * hits / F.nullif(total, F.lit(0)), digits)


def argmax_label(p_home: Column, p_draw: Column, p_away: Column) -> Column:
    """Most likely outcome; ties go home_win, then draw, then away_win. NULL if any
    probability is."""
    return (
        F.when(p_home.isNull() | p_draw.isNull() | p_away.isNull(), F.lit(None).cast("string"))
        .when((p_home >= p_draw) & (p_home >= p_away), F.lit("home_win"))
        .when(p_draw >= p_away, F.lit("draw"))
        .otherwise(F.lit("away_win"))
    )


def prob_of_outcome(outcome: Column, p_home: Column, p_draw: Column, p_away: Column) -> Column:
    return (
        F.when(outcome == "home_win", p_home)
        .when(outcome == "draw", p_draw)
        .when(outcome == "away_win", p_away)
    )


def log_loss_term(p: Column, eps: float = config.LOG_LOSS_EPS) -> Column:
    """-ln(p), p at least ``eps``; NULL stays NULL (``greatest`` would skip it)."""
    return F.when(p.isNotNull(), -F.ln(F.greatest(p, F.lit(eps))))


def poisson_pmf(k: Column, mu: Column) -> Column:
    """exp(-mu) * mu^k / k!"""
    return F.exp(-mu) * F.pow(mu, k) / F.factorial(k).cast("double")
