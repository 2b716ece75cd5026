"""Governed SQL: each rule of the gate with statements of its own, the cap, the dictionary."""

from __future__ import annotations

import pytest

from pitchside.plans import access
from pitchside.plans.pipeline import published_relations
from pitchside.sources import sinks

# statement -> number of rows it gives under a cap of 7
ACCEPTED = {
    "SELECT champion, runner_up FROM mart.edition_kpis": 2,
    "SELECT stage_type, max(total_goals) AS most FROM mart.int_match_stages GROUP BY stage_type": 2,
    "SELECT p.home_team FROM predict.predictions AS p WHERE p.prob_draw < (SELECT avg(q.prob_draw) FROM predict.predictions AS q)": 7,
    "TABLE mart.edition_kpis": 2,
    "(SELECT year FROM mart.edition_kpis) EXCEPT (SELECT 1998)": 1,
    "WITH k AS (SELECT year FROM mart.edition_kpis), l AS (SELECT year + 1 AS y FROM k) SELECT * FROM l": 2,
    "SELECT * FROM (WITH k AS (SELECT year FROM mart.edition_kpis) SELECT * FROM k) x": 2,
    "WITH k AS (SELECT 1 AS one) SELECT year, one FROM mart.edition_kpis, k": 2,
    "SELECT `year` FROM `mart`.`edition_kpis` -- quoted": 2,
    "SELECT year FROM MART.Edition_KPIs LIMIT 1": 1,
}

# rule -> statements that break it
REFUSED = {
    "writes and definitions": [
        "INSERT OVERWRITE mart.edition_kpis SELECT * FROM mart.edition_kpis",
        "TRUNCATE TABLE mart.knockout_analysis",
        "ALTER TABLE mart.edition_kpis RENAME TO mart.gone",
        "CREATE OR REPLACE TEMP VIEW v AS SELECT year FROM mart.edition_kpis",
        "MERGE INTO mart.edition_kpis t USING mart.edition_kpis s ON t.year = s.year WHEN MATCHED THEN DELETE",
    ],
    "session commands": ["USE raw", "REFRESH TABLE mart.edition_kpis", "RESET", "ADD FILE '/etc/hostname'", "DESCRIBE mart.edition_kpis", "EXPLAIN SELECT year FROM mart.edition_kpis"],
    "one statement": ["SELECT year FROM mart.edition_kpis; SELECT year FROM mart.edition_kpis", "", " ; "],
    "other relations": [
        "SELECT n FROM hidden_view, mart.edition_kpis",
        "SELECT a.year FROM mart.edition_kpis a LEFT JOIN private.ledger b ON TRUE",
        "SELECT year FROM mart.edition_kpis UNION SELECT n FROM private.ledger",
        "SELECT (SELECT max(n) FROM private.ledger) AS m FROM mart.edition_kpis",
        "SELECT year FROM mart.edition_kpis WHERE year NOT IN (SELECT n FROM private.ledger)",
        "SELECT year FROM mart.edition_kpis k, LATERAL (SELECT n FROM private.ledger WHERE n = k.year)",
        "SELECT year FROM spark_catalog.private.ledger, mart.edition_kpis",
    ],
    "files as tables": ["SELECT * FROM text.`/etc/passwd`", "SELECT year FROM mart.edition_kpis JOIN orc.`/srv/x` USING (year)"],
    "functions": ["SELECT id FROM range(3), mart.edition_kpis", "SELECT java_method('java.util.UUID', 'randomUUID') FROM mart.edition_kpis", "SELECT year FROM mart.edition_kpis WHERE try_reflect('java.lang.Runtime', 'getRuntime') IS NULL"],
    "dynamic names": ["SELECT year FROM IDENTIFIER('mart' || '.edition_kpis')", "EXECUTE IMMEDIATE 'SELECT year FROM mart.edition_kpis'"],
    "no published table": ["SELECT 42", "WITH k AS (SELECT 1 AS one) SELECT one FROM k"],
    "scope of common table expressions": [
        "WITH `private.ledger` AS (SELECT 1 AS x) SELECT * FROM private.ledger, mart.edition_kpis",
        "WITH `parquet./srv/data` AS (SELECT 1 AS x) SELECT * FROM parquet.`/srv/data`, mart.edition_kpis",
        "WITH hidden_view AS (SELECT * FROM hidden_view) SELECT * FROM hidden_view, mart.edition_kpis",
        "SELECT * FROM (WITH hidden_view AS (SELECT year FROM mart.edition_kpis) SELECT * FROM hidden_view) a, hidden_view b",
        "WITH early AS (SELECT * FROM hidden_view), hidden_view AS (SELECT year FROM mart.edition_kpis) SELECT * FROM early",
        "SELECT year FROM mart.edition_kpis WHERE year IN (WITH hidden_view AS (SELECT 1998 AS n) SELECT n FROM hidden_view) OR EXISTS (SELECT n FROM hidden_view)",
    ],
}


@pytest.fixture(scope="module")
def published(spark, wh, tmp_path_factory):
    rel = published_relations(wh)
    sinks.publish(spark, rel, str(tmp_path_factory.mktemp("snapshot")))
    spark.range(3).toDF("n").createOrReplaceTempView("hidden_view")
    sinks.save_table(spark, spark.range(3).toDF("n"), "private.ledger", str(tmp_path_factory.mktemp("ledger") / "t"))
    return rel


@pytest.mark.parametrize("sql", ACCEPTED)
def test_accepted_statements(spark, published, sql):
    assert access.bounded_query(spark, sql, max_rows=7).count() == ACCEPTED[sql]


@pytest.mark.parametrize(("rule", "sql"), [(rule, s) for rule, many in REFUSED.items() for s in many])
def test_refused_statements(spark, published, rule, sql):
    with pytest.raises(access.QueryRejected):
        access.bounded_query(spark, sql)
    assert spark.table("mart.edition_kpis").count() == 2


def test_a_view_under_a_published_name_is_refused_by_its_leaves(spark, published):
    spark.sql("CREATE DATABASE IF NOT EXISTS decoy")
    spark.sql("CREATE OR REPLACE VIEW decoy.kpis AS SELECT * FROM private.ledger")
    with pytest.raises(access.QueryRejected):
        access.bounded_query(spark, "SELECT * FROM decoy.kpis", allowed=frozenset({"decoy.kpis"}))
    spark.sql("DROP VIEW decoy.kpis")


def test_the_smaller_of_cap_and_limit_holds(spark, published):
    rows = lambda sql, cap: access.bounded_query(spark, sql, max_rows=cap).count()
    assert [rows(f"SELECT team FROM mart.int_team_matches {tail}", cap) for tail, cap in (("", 31), ("LIMIT 5", 31), ("LIMIT 90", 8))] == [31, 5, 8]


def test_fixture_lookup_finds_either_order_and_case(spark, published):
    from pitchside.plans import dashboard

    preds = spark.table("predict.predictions")
    one, other = (dashboard.fixture_lookup(preds, *names).collect() for names in (("nation_4", "Nation_5"), ("NATION_5", "NATION_4")))
    assert one == other and {one[0]["home_team"], one[0]["away_team"]} == {"NATION_4", "NATION_5"} and len(one) == 1


def test_dictionary_covers_every_published_column(spark, published):
    schemas = {t: spark.table(t).schema for t in access.PUBLISHED}
    rows = access.data_dictionary(spark, schemas).collect()
    assert {(r["table"], r["column"], r["type"]) for r in rows} == {(t, f.name, f.dataType.simpleString()) for t, s in schemas.items() for f in s.fields}
    assert all(r["description"] and r["grain"] for r in rows) and not any(access.undocumented(s) for s in schemas.values())
    used = {f.name for s in schemas.values() for f in s.fields}
    assert set(access.COLUMN_NOTES) <= used  # no note without a column


def test_notes_travel_with_the_files(spark, published):
    field = spark.table("mart.knockout_analysis").schema["pen_shootouts"]
    assert field.metadata["comment"] == access.COLUMN_NOTES["pen_shootouts"]
