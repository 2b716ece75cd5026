"""Numbered versions, snapshots, the stage ledger and observed writes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pitchside.plans import catalog, pipeline, predict
from pitchside.plans.layers import Warehouse
from pitchside.sources import bridge, files, hadoop, sinks, store
from pitchside.sources.ledger import Ledger, fingerprint
from pitchside.sources.versions import Conflict, Versions

from .conftest import SF_SMALL


def _broken(spark):
    return spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))


def test_create_if_absent_refuses_the_second(spark, tmp_path):
    path = f"{tmp_path}/deep/er/marker"
    assert hadoop.create_if_absent(spark, path, "first \u00fc")
    assert not hadoop.create_if_absent(spark, path, "second")
    assert hadoop.read_text(spark, path) == "first \u00fc"
    assert hadoop.names(spark, f"{tmp_path}/deep/er") == ["marker"]
    assert hadoop.names(spark, f"{tmp_path}/none") == []


def test_of_two_writers_the_second_is_refused(spark, tmp_path):
    v = Versions(spark, f"{tmp_path}/t")
    v.write({"t": spark.range(3)})
    mine, theirs = v.draft(), v.draft()
    spark.range(5).write.parquet(theirs.path("t"))
    spark.range(7).write.parquet(mine.path("t"))
    theirs.commit(["t"])
    with pytest.raises(Conflict):
        mine.commit(["t"])
    assert v.version().number == 2 and v.tables()["t"].count() == 5
    v.write({"t": spark.range(4)})  # clears what the refused writer left
    assert not os.path.exists(f"{tmp_path}/t/{mine.folder}")


def test_kept_versions_and_a_reader_of_the_one_before(spark, tmp_path):
    v = Versions(spark, f"{tmp_path}/t", keep=2)
    v.write({"t": spark.range(1)})
    old = v.tables()["t"]
    v.write({"t": spark.range(2)})
    assert old.count() == 1  # its files have one more commit to live
    for n in (3, 4, 5):
        v.write({"t": spark.range(n)})
    assert v.numbers() == [4, 5] and len([n for n in os.listdir(f"{tmp_path}/t") if n.startswith("d-")]) == 2
    assert v.tables(4)["t"].count() == 4 and v.version().info["n_rows"] == {"t": 5}
    with pytest.raises(FileNotFoundError):
        v.tables(1)
    with pytest.raises(ValueError):
        Versions(spark, f"{tmp_path}/t", keep=0)


def test_a_draft_of_a_running_writer_is_left_alone(spark, tmp_path):
    v = Versions(spark, f"{tmp_path}/t", keep=1)
    v.write({"t": spark.range(1)})
    running = v.draft()  # number 2
    spark.range(9).write.parquet(running.path("t"))
    v.prune()
    assert running.commit(["t"]).number == 2 and v.tables()["t"].count() == 9


def test_failing_the_fourth_write_leaves_all_seven_tables(spark, tmp_path):
    names = [f"snap.t{i}" for i in range(7)]
    where = f"{tmp_path}/snapshot"
    sinks.publish(spark, {n: spark.range(10 + i) for i, n in enumerate(names)}, where)
    new = {n: (_broken(spark) if i == 3 else spark.range(100 + i)) for i, n in enumerate(names)}
    with pytest.raises(Exception, match="broken"):
        sinks.publish(spark, new, where)
    assert [df.count() for df in sinks.open_snapshot(spark, where).values()] == list(range(10, 17))
    assert [spark.table(n).count() for n in names] == list(range(10, 17))
    assert len([n for n in os.listdir(where) if n.startswith("d-")]) == 1
    sinks.publish(spark, {n: spark.range(100 + i) for i, n in enumerate(names)}, where)
    assert [df.count() for df in sinks.open_snapshot(spark, where).values()] == list(range(100, 107))
    assert [df.count() for df in sinks.open_snapshot(spark, where, 1).values()] == list(range(10, 17))
    assert [spark.table(n).count() for n in names] == list(range(100, 107))


def test_replaced_tables_have_a_current_version(spark, tmp_path):
    root = f"{tmp_path}/r"
    for n in (2, 3, 4):
        df, path = files.replace_table(spark.range(n), root)
    assert df.count() == files.current_table(spark, root).count() == 4
    assert Versions(spark, root).numbers() == [2, 3]
    with pytest.raises(Exception, match="broken"):
        files.replace_table(_broken(spark), root)
    assert files.current_table(spark, root).count() == 4


def test_observed_writes_count_what_they_write(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("x"))
    got = store.write_observed(df.orderBy("x"), f"{tmp_path}/a", F.count("x").alias("known"), F.max("x").alias("most"))
    assert got == {"n_rows": 1000, "known": 250, "most": 996}
    assert store.write_observed(df.limit(0), f"{tmp_path}/b") == {"n_rows": 0}


def test_ledger_runs_again_on_other_inputs_or_lost_outputs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("1")
    key = fingerprint(spark, f"{tmp_path}/in", 3.0)
    assert key == fingerprint(spark, f"{tmp_path}/in", 3.0) != fingerprint(spark, f"{tmp_path}/in", 4.0)
    out = tmp_path / "out"
    runs = []

    def work():
        runs.append(1)
        out.mkdir(exist_ok=True)
        return {"paths": {"x": str(out)}}

    ledger = Ledger(spark, f"{tmp_path}/ledger", key)
    for expected in (True, False):
        assert ledger.run("s", work, lambda r: list(r["paths"].values())) == ({"paths": {"x": str(out)}}, expected)
    out.rmdir()
    assert ledger.run("s", work, lambda r: list(r["paths"].values()))[1]
    (tmp_path / "in" / "b").write_text("2")
    assert fingerprint(spark, f"{tmp_path}/in", 3.0) != key
    assert len(runs) == 2


def test_a_killed_job_goes_on_behind_its_last_step(spark, tmp_path, monkeypatch):
    out, prefix = f"{tmp_path}/job", "resumed_"
    with monkeypatch.context() as m:
        m.setattr(predict, "predictions", lambda wh: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix=prefix)
    with monkeypatch.context() as m:
        m.setattr(bridge, "load_raw", lambda *a, **k: pytest.fail("the bridge was read again"))
        m.setattr(pipeline.Warehouse, "write_layers", lambda *a, **k: pytest.fail("the layers were built again"))
        second = pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix=prefix)
        assert (second.skipped, second.steps) == (["ingest", "build"], ["predict", "publish"])
        third = pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix=prefix)
        assert third.steps == [] and third.published == second.published and third.layer_counts == second.layer_counts
    names = sinks.open_snapshot(spark, f"{out}/snapshot")
    assert len(names) == 7 and names["predict.predictions"].count() == third.prob_sum_check["n_fixtures"]
    again = pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix=prefix, resume=False)
    assert again.steps == list(pipeline.STEPS) and Versions(spark, f"{out}/snapshot").numbers() == [1, 2]
    assert again.layer_counts == second.layer_counts
    # raw tables keep two versions, their counts were taken while writing
    assert again.raw_counts["matches"] == spark.read.parquet(again.raw_paths["matches"]).count()


def test_a_job_whose_draft_lost_its_number_builds_again(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/job"
    with monkeypatch.context() as m:
        m.setattr(sinks, "publish_draft", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix="lost_")
    Versions(spark, f"{out}/snapshot").write({"other": spark.range(1)})
    done = pipeline.run_pipeline(spark, out, sf_dir=SF_SMALL, prefix="lost_")
    assert done.skipped == ["ingest"] and Versions(spark, f"{out}/snapshot").version().number == 2


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Star tables with a repeated order and lines without a supplier, a quantity or a tax."""
    where = str(tmp_path_factory.mktemp("star"))
    spark.range(3).selectExpr("id AS r_regionkey", "concat('REGION_', id) AS r_name").write.parquet(f"{where}/region.parquet")
    spark.range(6).selectExpr("id AS n_nationkey", "concat('NATION_', id) AS n_name", "id % 3 AS n_regionkey").write.parquet(f"{where}/nation.parquet")
    spark.range(12).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "id % 6 AS c_nationkey").write.parquet(f"{where}/customer.parquet")
    spark.range(8).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name", "(id * 5) % 6 AS s_nationkey").write.parquet(f"{where}/supplier.parquet")
    orders = spark.range(60).selectExpr(
        "id AS o_orderkey", "id % 12 AS o_custkey", "'O' AS o_orderstatus", "id * 10.5D AS o_totalprice",
        "make_timestamp_ntz(1997 + CAST(id % 4 AS INT), 1 + CAST(id % 12 AS INT), 3, 0, 0, 0) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.unionByName(orders.where("o_orderkey = 7")).write.parquet(f"{where}/orders.parquet")
    spark.range(900).selectExpr(
        "id % 60 AS l_orderkey", "id * 7 AS l_partkey", "nullif(id % 9, 8) AS l_suppkey", "CAST(1 + id % 7 AS INT) AS l_linenumber",
        "CAST(nullif(id % 11, 10) AS DOUBLE) AS l_quantity", "id * 1.5D AS l_extendedprice", "(id % 8) / 16.0D AS l_discount", "nullif((id % 5) / 32.0D, 0.0D) AS l_tax",
    ).write.parquet(f"{where}/lineitem.parquet")
    return where


def test_published_marts_do_not_join_the_raw_matches_again(spark, star, monkeypatch):
    """Every write of a mart starts from the written matches, not from the star tables."""
    read, publish = [], sinks.publish

    def seen(spark, relations, *args, **options):
        read.extend(f for df in relations.values() for f in df.inputFiles())
        return publish(spark, relations, *args, **options)

    monkeypatch.setattr(sinks, "publish", seen)
    wh = Warehouse.from_star(spark, star)
    got = {r["relation"]: r["n_rows"] for r in catalog.s9(wh).collect()}
    assert got == {"team_performance": wh.team_performance.count(), "knockout_analysis": wh.knockout_analysis.count()}
    assert min(got.values()) > 0
    assert read and not [f for f in read if star in f]


def test_written_matches_give_the_same_marts(spark, star):
    wh = Warehouse.from_star(spark, star)
    narrow = wh.with_written_matches(catalog.MART_MATCH_COLS)
    for name in ("team_performance", "knockout_analysis"):
        rows = [sorted(map(str, getattr(w, name).collect())) for w in (wh, narrow)]
        assert rows[0] == rows[1] and rows[0]
