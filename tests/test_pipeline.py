"""End-to-end batch job, sources and sinks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pitchside.plans.pipeline import STEPS, run_pipeline
from pitchside.sources import bridge, files, sinks
from pitchside.sources.schemas import RAW_SOURCES

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pipeline"))
    return out, run_pipeline(spark, out, sf_dir=SF_SMALL)


def test_steps_in_order(run):
    _, res = run
    assert res.steps == list(STEPS)


def test_layer_counts_consistent(run):
    _, res = run
    c = res.layer_counts
    assert c["mart.int_team_matches"] == 2 * c["stg.matches"]
    assert c["mart.edition_kpis"] == 2


def test_predictions_written_and_sane(spark, run):
    out, res = run
    csv = spark.read.option("header", True).csv(res.predictions_csv)
    assert csv.count() == spark.table("predict.predictions").count() > 0
    chk = res.prob_sum_check
    assert chk["unscored"] == 0
    assert 0.999 <= chk["min_prob_sum"] <= chk["max_prob_sum"] <= 1.001


def test_table_sink_is_idempotent(spark, run, tmp_path):
    df = spark.table("predict.predictions")
    n = df.count()
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.save_table(spark, df, "predict.scratch_copy", path)
        assert spark.table("predict.scratch_copy").count() == n
    sinks.save_table(spark, df.limit(1), "predict.scratch_copy", str(tmp_path / "t2"))
    assert spark.table("predict.scratch_copy").count() == 1
    sinks.save_table(spark, spark.range(3), "predict.scratch_copy", path)  # another schema
    assert spark.table("predict.scratch_copy").columns == ["id"]


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.save_table(spark, spark.range(5), "predict.kept", path)
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.save_table(spark, bad, "predict.kept", path)
    assert spark.table("predict.kept").count() == 5


def test_csv_columns_go_by_header_name(spark, tmp_path):
    from pitchside.sources.schemas import SCHEDULE

    def read(name, text):
        (tmp_path / name).write_text(text)
        return files.read_csv(spark, str(tmp_path / name), SCHEDULE)

    got = read("swapped.csv", "Round,Date,away_team,extra,home_team,Notes\nFinal,2002-06-30,Away,1,Home,\n")
    assert got.columns == SCHEDULE.names
    row = got.first()
    assert (row["home_team"], row["away_team"], str(row["Date"]), row["Notes"]) == ("Home", "Away", "2002-06-30", None)
    with pytest.raises(ValueError, match="home_team"):
        read("lacking.csv", "Round,Date,away_team,Notes\nFinal,2002-06-30,Away,\n")
    with pytest.raises(ValueError, match="away_team"):
        read("twice.csv", "Round,Date,home_team,away_team,away_team,Notes\nFinal,2002-06-30,H,A,B,\n")


def test_published_snapshot(spark, run):
    _, res = run
    assert set(res.published) >= {"mart.edition_kpis", "predict.predictions"}
    for path in res.published.values():
        assert os.path.isdir(path)


def test_csv_round_trip_gives_same_layers(spark, run, tmp_path):
    """Raw inputs written as CSV files and read back with explicit schemas."""
    raw = bridge.load_raw(spark, SF_SMALL)
    tables = {"matches": raw.matches, "world_cup": raw.world_cup, "schedule": raw.schedule, **raw.rankings}
    for name, (fname, _) in RAW_SOURCES.items():
        sinks.write_csv(tables[name], str(tmp_path / fname))
    out = str(tmp_path / "out")
    res = run_pipeline(spark, out, csv_dir=str(tmp_path), steps=("ingest", "build"))
    assert res.layer_counts == run[1].layer_counts


def test_missing_source_fails_before_reading(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw_csv(spark, str(tmp_path))


def test_catalog_profile(spark):
    raw = bridge.load_raw(spark, SF_SMALL)
    prof = files.catalog_profile({"world_cup": raw.world_cup, "schedule": raw.schedule})
    rows = prof.where(F.col("table") == "world_cup").collect()
    assert [r["column"] for r in rows][:3] == ["Year", "Host", "Teams"]
    assert rows[0]["n_rows"] == raw.world_cup.count()


def test_scalar(spark):
    assert files.scalar(spark.range(5).agg(F.sum("id"))) == 10
    with pytest.raises(ValueError):
        files.scalar(spark.range(0))


def test_rejects_are_kept_with_file_and_reason(spark, tmp_path):
    from pitchside.sources.schemas import SCHEDULE

    folder = tmp_path / "s.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('Round,Date,home_team,away_team,Notes,more\nFinal,2002-06-30,"Big, Home",Away,,1\nFinal,30 June,H,A,x,2\nFinal,2002-06-30,H,A\n')
    (folder / "b.csv").write_text("Round,Date,home_team,away_team,Notes,more\n,,,,,\nFinal,2002-06-30,H,A,n,1,one too many\n")
    good, rejects, counts = files.load_csv(spark, str(folder), SCHEDULE, str(tmp_path / "staged"), max_error_share=0.6)
    assert counts == {"n_rows": 2, "n_rejects": 3} and good.count() == 2 and good.columns == SCHEDULE.names
    assert {tuple(r) for r in good.select("home_team", "Notes").collect()} == {("Big, Home", None), (None, None)}
    got = {(r["file"].rsplit("/", 1)[1], r["record"], r["reason"]) for r in rejects.collect()}
    assert got == {
        ("a.csv", "Final,30 June,H,A,x,2", "no value of its type: Date"),
        ("a.csv", "Final,2002-06-30,H,A", "not 6 fields"),
        ("b.csv", "Final,2002-06-30,H,A,n,1,one too many", "not 6 fields"),
    }
    with pytest.raises(files.TooManyRejects, match="3 of 5"):
        files.load_csv(spark, str(folder), SCHEDULE, str(tmp_path / "staged2"), max_error_share=0.5)


def test_rejects_of_a_job(spark, run, tmp_path):
    raw = bridge.load_raw(spark, SF_SMALL)
    tables = {"matches": raw.matches, "world_cup": raw.world_cup, "schedule": raw.schedule, **raw.rankings}
    for name, (fname, _) in RAW_SOURCES.items():
        sinks.write_csv(tables[name], str(tmp_path / fname))
    bad = tmp_path / RAW_SOURCES["matches"][0] / "part-bad.csv"
    bad.write_text(",".join(tables["matches"].columns) + "\nnever" + "," * (len(tables["matches"].columns) - 1) + "\n")
    out = str(tmp_path / "out")
    with pytest.raises(files.TooManyRejects):
        run_pipeline(spark, out, csv_dir=str(tmp_path), steps=("ingest", "build"))
    res = run_pipeline(spark, out, csv_dir=str(tmp_path), steps=("ingest", "build"), max_error_share=0.001)
    assert res.layer_counts == run[1].layer_counts
    assert res.reject_counts == {"matches": 1, "world_cup": 0, "schedule": 0, "ranking_old": 0, "ranking_new": 0}
    row = files.current_table(spark, f"{out}/rejects/matches").first()
    assert row["file"].endswith("part-bad.csv") and row["reason"] == "no value of its type: Year"
