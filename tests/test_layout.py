"""Co-located join, clustered extracts, and the deadline and cost bound of the gate."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from pitchside.plans import access, dashboard, predict
from pitchside.plans.layers import Warehouse
from pitchside.sources import bridge, colocated, sinks, store

from .conftest import SF_SMALL


def _nodes(df):
    """(name, plan node) of the final adaptive plan."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            walk(node.plan())
        out.append((name, node))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_bucketed_orders_and_line_items_are_joined_without_an_exchange(spark, wh):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def on_keys(df):
            return [str(n.outputPartitioning()) for name, n in _nodes(df) if "ShuffleExchange" in name and "orderkey" in str(n.outputPartitioning())]

        plain = bridge.load_raw(spark, SF_SMALL, wh.scope.years).matches
        assert on_keys(plain)
        star = colocated.colocated_star(spark, SF_SMALL, buckets=4)
        raw = bridge.load_raw(spark, SF_SMALL, wh.scope.years, star)
        assert on_keys(raw.matches) == []
        plan = raw.matches._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "PushedFilters: [Or(And(GreaterThanOrEqual(o_orderdate" in plan
        key = lambda df: sorted(map(str, df.collect()))
        assert key(Warehouse(raw, wh.scope).stg_matches) == key(wh.stg_matches)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_follow_the_file_size(spark):
    cores = spark.sparkContext.defaultParallelism
    assert colocated.bucket_count(spark, SF_SMALL) == cores
    assert colocated.bucket_count(spark, SF_SMALL, bucket_bytes=1000) > 10 * cores


def _rows_scanned(df) -> int:
    return sum(n.metrics().apply("numOutputRows").value() for name, n in _nodes(df) if name == "FileSourceScanExec")


def test_lookups_read_few_row_groups(spark, tmp_path):
    rows = spark.range(400_000).selectExpr(
        "1990 + id % 20 AS year", "id % 6 + 1 AS stage_order", "date_add(DATE'1990-01-01', CAST(id % 700 AS INT)) AS match_date",
        "concat('TEAM ', hash(id) % 20000) AS home_team", "id AS n").withColumn("home_key", F.lower("home_team"))
    path = f"{tmp_path}/m"
    sinks.write_clustered(rows, path, ["year", "stage_order", "match_date"], ["home_key"], files=4, row_group_bytes=64 << 10)
    m = spark.read.parquet(path)
    by_year = m.where("year = 2003")
    assert by_year.count() == 20_000 and _rows_scanned(by_year.select("n")) < 60_000
    name = m.where("year = 1995").first()["home_key"]
    one = m.where(F.col("home_key") == name)
    assert set(r["home_key"] for r in one.collect()) == {name}
    assert _rows_scanned(one.select("n")) < 200_000  # the bloom filters skip row groups without it
    missing = m.where(F.col("home_key") == "nobody")
    assert missing.count() == 0 and _rows_scanned(missing.select("n")) < 20_000


def test_extract_lookups_equal_the_lookups(spark, wh, tmp_path):
    preds = store.materialize(predict.predictions(wh), "layout_predictions")
    dashboard.write_lookup_extracts(wh, str(tmp_path), preds)
    some = preds.first()
    team = some["home_team"]
    for name in (team, team.lower(), team.title()):
        got, expected = (sorted(map(tuple, df.collect())) for df in (dashboard.team_lookup_extract(spark, str(tmp_path), name, 2000), dashboard.team_lookup(wh, name, 2000)))
        assert got == expected != []
    for a, b in ((team, some["away_team"]), (some["away_team"].lower(), team)):
        got = dashboard.fixture_lookup_extract(spark, str(tmp_path), a, b)
        assert sorted(map(tuple, got.select(*preds.columns).collect())) == sorted(map(tuple, dashboard.fixture_lookup(preds, a, b).collect())) != []
    plan = dashboard.team_lookup_extract(spark, str(tmp_path), team.title(), 2000)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(team_key,{team.lower()})" in plan


@pytest.fixture(scope="module")
def governed(spark, tmp_path_factory):
    table = f"{store.database_prefix(spark)}gate.numbers"
    sinks.save_table(spark, spark.range(3000), table, str(tmp_path_factory.mktemp("gate") / "t"))
    return table


def test_a_slow_statement_is_ended_and_others_go_on(spark, governed):
    slow = f"SELECT count(*) AS n FROM {governed} a JOIN {governed} b ON a.id % 2 = b.id % 2 JOIN {governed} c ON b.id % 2 = c.id % 2"
    others: list = []
    run = threading.Thread(target=lambda: others.append(spark.range(0, 10**9, 1, 4).selectExpr("sum(id % 7)").collect()))
    run.start()
    began = time.time()
    with pytest.raises(access.DeadlineExceeded, match="2 s"):
        access.run_bounded(spark, slow, frozenset({governed}), deadline=2.0)
    assert time.time() - began < 30
    run.join()
    assert len(others) == 1
    columns, rows = access.run_bounded(spark, f"SELECT id FROM {governed} ORDER BY id", frozenset({governed}), max_rows=3)
    assert columns == ["id"] and [r[0] for r in rows] == [0, 1, 2]


def test_a_large_plan_is_refused_before_it_runs(spark, governed):
    product = f"SELECT a.id FROM {governed} a, {governed} b, {governed} c LIMIT 5"
    with pytest.raises(access.QueryRejected, match="too large"):
        access.bounded_query(spark, product, frozenset({governed}), max_bytes=1 << 30)
    with pytest.raises(access.QueryRejected, match="too large"):
        access.run_bounded(spark, product, frozenset({governed}), max_bytes=1 << 30)
    assert access.bounded_query(spark, f"SELECT max(id) AS m FROM {governed}", frozenset({governed}), max_bytes=1 << 30).first()["m"] == 2999


def test_errors_of_a_statement_reach_the_caller(spark, governed):
    with pytest.raises(Exception, match="(?i)divi"):
        access.run_bounded(spark, f"SELECT raise_error('division') FROM {governed}", frozenset({governed}))
