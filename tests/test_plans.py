"""Physical-plan properties the design relies on."""

from __future__ import annotations

from pitchside.plans import backtest, questions
from pitchside.plans.layers import Warehouse

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_filter_reaches_the_orders_scan(spark):
    wh = Warehouse.from_star(spark, SF_SMALL, materialize=False)
    plan = _plan(wh.stg_matches)
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(o_orderdate" in plan


def test_unpivot_scans_match_input_once(spark):
    wh = Warehouse.from_star(spark, SF_SMALL, materialize=True)
    plan = _plan(wh.int_team_matches)
    assert plan.count("FileScan parquet") == 1  # one scan of the materialised match table
    assert "Generate" in plan and "Union" not in plan


def test_sweep_is_one_query_without_python(spark):
    wh = Warehouse.from_star(spark, SF_SMALL)
    plan = _plan(backtest.sweep(wh))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_udf_and_no_cross_join_in_registered_queries(spark):
    from pitchside.plans.registry import queries

    for name, fn in queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        for bad in ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def _final_plan(df) -> str:
    """The plan after adaptive execution, exchanges included."""
    df.collect()
    return _plan(df)


def test_match_rows_are_not_sorted_for_the_edition_figures(spark):
    from pitchside.operators import marts

    wh = Warehouse.from_star(spark, SF_SMALL, materialize=True)
    per_host = wh.edition_kpis
    assert marts and "HashAggregate(keys=[year" in _plan(per_host)
    below = _plan(per_host).split("HashAggregate(keys=[year", 1)[1]
    assert "any_value" not in below.split("FileScan")[0].split("partial_count(1)")[-1]


def test_match_rows_are_not_exchanged_on_teams(spark):
    wh = Warehouse.from_star(spark, SF_SMALL, materialize=True)
    plan = _final_plan(backtest.scored_test_matches(wh))
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final
    assert "hashpartitioning(home_team" not in final and "hashpartitioning(away_team" not in final


def test_layer_counts_scan_the_matches_once(spark):
    from pitchside.plans.registry import queries

    plan = _final_plan(queries()["s5_layer_counts"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert "lineitem" not in plan


def test_top_k_is_a_per_partition_top_k(spark):
    wh = Warehouse.from_star(spark, SF_SMALL)
    assert "TakeOrderedAndProject" in _plan(questions.q2_top_attack(wh))
