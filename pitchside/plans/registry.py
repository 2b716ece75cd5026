"""Registered queries: one per operator ID of the inventory, named
``<id>_<slug>``. Each takes (spark, sf_dir) and returns a lazy DataFrame
over the whole star tables under ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchside.plans.layers import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str, materialize: bool = False):
    """``materialize``: write the scoped match table first, for plans that
    read it in many branches (model fitting, scoring, back-test)."""

    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Warehouse.from_star(spark, sf_dir, materialize=materialize))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.materialize = materialize
        _REGISTRY[name] = run
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    # import for side effects: each module registers its queries
    from pitchside.plans import catalog  # noqa: F401

    return dict(_REGISTRY)


MATCH_KEYS = ("year", "match_date", "round", "home_team", "away_team")
