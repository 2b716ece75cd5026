"""End-to-end batch job (S10, S11): ingest -> build -> predict -> publish.

Every step is DataFrame in, DataFrame out; the only actions are the writes. Each relation is
written once, with its counts and checks taken by the tasks that write it, and what follows reads
its files, so a lost executor recomputes from files. Finished steps are in a ledger: a driver that
was ended starts again with the first unfinished step. Marts and predictions are written into one
new version of the snapshot folder, which the last step makes current by one commit.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pitchside import config
from pitchside.config import DEFAULT_SCOPE, Scope
from pitchside.plans import predict as pr
from pitchside.plans.access import PUBLISHED, with_comments
from pitchside.plans.layers import Warehouse
from pitchside.sources import bridge, files, sinks, store
from pitchside.sources.bridge import RawTables
from pitchside.sources.ledger import Ledger, fingerprint
from pitchside.sources.schemas import RAW_SOURCES
from pitchside.sources.versions import Conflict, Draft, Versions

STEPS = ("ingest", "build", "predict", "publish")
PREDICTIONS = "predict.predictions"


@dataclass
class PipelineResult:
    steps: list[str] = field(default_factory=list)
    raw_paths: dict[str, str] = field(default_factory=dict)
    layer_counts: dict[str, int] = field(default_factory=dict)
    predictions_csv: str | None = None
    published: dict[str, str] = field(default_factory=dict)
    prob_sum_check: dict | None = None
    raw_counts: dict[str, int] = field(default_factory=dict)
    reject_counts: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)  # steps that an earlier run had finished


def raw_from_csv(
    spark: SparkSession, csv_dir: str, crosswalk: DataFrame, staging: str | None = None, max_error_share: float = 0.0
) -> tuple[RawTables, dict[str, DataFrame]]:
    """Raw inputs from CSV files of the source registry (S1 + S2), and the rejects of each.

    Without a ``staging`` folder the files are read where they are used, and a row that does not
    fit fails the job; with one they are read once, and rejects are kept up to a share."""
    rejects: dict[str, DataFrame] = {}
    if staging is None:
        t = files.read_raw_csv(spark, csv_dir)
    else:
        files.check_sources(spark, csv_dir)
        t = {}
        for name, (file, schema) in RAW_SOURCES.items():
            t[name], rejects[name], _ = files.load_csv(spark, f"{csv_dir.rstrip('/')}/{file}", schema, f"{staging}/{name}", max_error_share)
    raw = RawTables(
        matches=t["matches"], world_cup=t["world_cup"], schedule=t["schedule"],
        rankings={"ranking_old": t["ranking_old"], "ranking_new": t["ranking_new"]},
        crosswalk=crosswalk,
    )
    return raw, rejects


def ingest(raw: RawTables, raw_dir: str) -> dict:
    """A new version of every raw table; paths and row counts (taken while writing)."""
    tables = {"matches": raw.matches, "world_cup": raw.world_cup, "schedule": raw.schedule, **raw.rankings}
    paths, counts = {}, {}
    for name, df in tables.items():
        version = Versions(df.sparkSession, f"{raw_dir.rstrip('/')}/{name}").write({"table": df})
        paths[name], counts[name] = version.tables["table"], version.info["n_rows"]["table"]
    return {"paths": paths, "n_rows": counts}


def ingested(spark: SparkSession, paths: dict[str, str], crosswalk: DataFrame) -> RawTables:
    """The raw tables that ``ingest`` wrote."""
    loaded = {name: spark.read.parquet(path) for name, path in paths.items()}
    fixed = {name: loaded.pop(name) for name in ("matches", "world_cup", "schedule")}
    return RawTables(**fixed, rankings=loaded, crosswalk=crosswalk)


def published_relations(wh: Warehouse, predictions: DataFrame | None = None) -> dict[str, DataFrame]:
    """The relations consumers may read (the G2 allow-list), with column comments.
    ``predictions``: those already made, else they are made here."""
    rel = {
        "mart.edition_kpis": wh.edition_kpis,
        "mart.team_performance": wh.team_performance,
        "mart.int_match_stages": wh.int_match_stages,
        "mart.int_team_matches": wh.int_team_matches,
        "mart.knockout_analysis": wh.knockout_analysis,
        "mart.ranking_vs_result": wh.ranking_vs_result,
        "predict.predictions": pr.predictions(wh) if predictions is None else predictions,
    }
    assert set(rel) == set(PUBLISHED)
    return {name: with_comments(df) for name, df in rel.items()}


def run_pipeline(
    spark: SparkSession,
    out_dir: str,
    *,
    sf_dir: str | None = None,
    csv_dir: str | None = None,
    scope: Scope = DEFAULT_SCOPE,
    steps: tuple[str, ...] = STEPS,
    prefix: str = "",
    resume: bool = True,
    max_error_share: float = 0.0,
) -> PipelineResult:
    """Run the batch job. Inputs come from the star-schema bridge (``sf_dir``)
    or from raw CSV files (``csv_dir``). ``prefix`` goes before the database names of
    what is published, so that a trial run leaves the shared tables alone. Steps that a run with
    the same input files, scope and parameters has finished are skipped, unless ``resume`` is False.
    Of each CSV file a share of rows up to ``max_error_share`` may not fit its schema: they are
    written, with file and reason, under ``rejects`` of the output."""
    if (sf_dir is None) == (csv_dir is None):
        raise ValueError("give exactly one of sf_dir or csv_dir")
    res = PipelineResult()
    out = out_dir.rstrip("/")
    crosswalk = bridge.seeds.team_crosswalk(spark)
    key = fingerprint(spark, sf_dir or csv_dir, scope, config.SHRINKAGE_K, config.BLEND_WEIGHT, config.MAX_GOALS, max_error_share)
    ledger = Ledger(spark, f"{out}/ledger", key)

    def step(name: str, work, outputs=lambda r: list(r["paths"].values())) -> dict:
        if not resume:
            ledger.forget(name)
        record, ran = ledger.run(name, work, outputs)
        (res.steps if ran else res.skipped).append(name)
        return record

    def ingest_sources() -> dict:
        if sf_dir is not None:
            return ingest(bridge.load_raw(spark, sf_dir), f"{out}/raw") | {"rejects": {}}
        staging = f"{store.folder(spark)}/csv-{uuid.uuid4().hex}"
        raw, rejects = raw_from_csv(spark, csv_dir, crosswalk, staging, max_error_share)
        n = {name: Versions(spark, f"{out}/rejects/{name}").write({"table": df}).info["n_rows"]["table"] for name, df in rejects.items()}
        return ingest(raw, f"{out}/raw") | {"rejects": n}

    if "ingest" in steps:
        record = step("ingest", ingest_sources)
        res.reject_counts = record["rejects"]
        res.raw_paths, res.raw_counts = record["paths"], record["n_rows"]
        raw = ingested(spark, record["paths"], crosswalk)
    else:
        raw = bridge.load_raw(spark, sf_dir) if sf_dir is not None else raw_from_csv(spark, csv_dir, crosswalk)[0]

    snapshot = Versions(spark, f"{out}/snapshot")
    was = ledger.record("publish")
    if was and ((now := snapshot.version()) is None or now.number != was["number"]):
        ledger.forget("build", "predict", "publish")  # other inputs were published since
    wh, draft = Warehouse(raw, scope), None
    if "build" in steps:

        def build() -> dict:
            draft = snapshot.draft()
            counts = wh.write_layers(draft.path, with_comments)
            return {"number": draft.number, "folder": draft.folder, "paths": {n: draft.path(n) for n in counts}, "n_rows": counts}

        record = step("build", build)
        draft = Draft(snapshot, record["number"], record["folder"])
        wh.use_layers(record["paths"])
        res.layer_counts = {n: record["n_rows"][n] for n in wh.relations()}
    if "predict" in steps:

        def predict() -> dict:
            into = draft or snapshot.draft()
            path = into.path(PREDICTIONS)
            check = store.write_observed(with_comments(pr.predictions(wh)), path, *pr.probability_sum_columns())
            sinks.write_csv(spark.read.parquet(path), f"{out}/predictions_csv")
            return {"paths": {PREDICTIONS: path}, "csv": f"{out}/predictions_csv", "check": {k: v for k, v in check.items() if k != "n_rows"}}

        record = step("predict", predict, lambda r: [*r["paths"].values(), r["csv"]])
        res.predictions_csv, res.prob_sum_check = record["csv"], record["check"]
    if "publish" in steps:
        if draft is None or "predict" not in steps:
            raise ValueError("publish needs the build and predict steps")

        def publish() -> dict:
            names = {n: prefix + n for n in PUBLISHED}
            try:
                version = sinks.publish_draft(spark, draft, names)
            except Conflict:
                ledger.forget("build", "predict")  # their folder can no longer become a version
                raise
            return {"number": version.number, "paths": {prefix + n: p for n, p in version.tables.items()}}

        res.published = step("publish", publish)["paths"]
    return res
