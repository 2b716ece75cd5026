"""Governed read access to the published marts.

``bounded_query`` accepts one read-only query over the allow-listed
published tables and returns it capped at ``max_rows``. The check runs on
Spark's own parse tree (no parser of ours) before anything is executed,
because ``spark.sql`` runs commands eagerly, and again on the analysed plan. It uses
the classic session's JVM objects, so it cannot run over Spark Connect.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchside import config

# --------------------------------------------------------------- data dictionary

# The published relations, with what one row stands for. Columns and types are
# taken from the relations themselves.
PUBLISHED: dict[str, str] = {
    "mart.edition_kpis": "an edition",
    "mart.team_performance": "a team in an edition",
    "mart.int_match_stages": "a match",
    "mart.int_team_matches": "a side of a match, seen from its team",
    "mart.knockout_analysis": "a knockout round of an edition",
    "mart.ranking_vs_result": "a match of the edition that has rankings",
    "predict.predictions": "a fixture of the future schedule",
}

# What a column holds, wherever it is published.
COLUMN_NOTES: dict[str, str] = {
    "year": "calendar year that names the edition",
    "host": "who staged the edition",
    "venue": "where the match was played",
    "attendance": "people in the ground",
    "avg_attendance": "people per match, to the next whole number",
    "match_date": "day of the match",
    "date": "day the fixture is planned for",
    "round": "name of the phase",
    "stage_type": "group or knockout",
    "stage_order": "position of the phase in time, from 1",
    "home_team": "first-named team",
    "away_team": "second-named team",
    "team": "the team the row is about",
    "opponent": "the team it met",
    "is_home": "whether the team was named first",
    "home_score": "goals of the first-named team before any shoot-out",
    "away_score": "goals of the second-named team before any shoot-out",
    "home_goal_diff": "goals of the first-named team less those of the other",
    "home_xg": "chance quality of the first-named team, in goals",
    "away_xg": "chance quality of the second-named team, in goals",
    "home_pens": "shoot-out goals of the first-named team, if there was one",
    "away_pens": "shoot-out goals of the second-named team, if there was one",
    "pens_for": "the team's shoot-out goals, if there was one",
    "pens_against": "the opponent's shoot-out goals, if there was one",
    "home_manager": "coach of the first-named team",
    "away_manager": "coach of the second-named team",
    "home_captain": "captain of the first-named team",
    "away_captain": "captain of the second-named team",
    "referee": "who refereed",
    "notes": "free text of the source",
    "total_goals": "goals of both teams together",
    "decided_on_pens": "whether a shoot-out settled it",
    "result_regulation": "outcome by the score alone: home_win, draw or away_win",
    "result": "the team's outcome by the score alone: win, draw or loss",
    "winner": "who went through, by score or shoot-out; empty if nobody did",
    "won_match": "whether the team is the winner; empty if nobody is",
    "goals_minus_xg": "goals less chance quality (per match in edition_kpis)",
    "n_matches": "matches counted",
    "matches": "matches the team played",
    "goals_per_match": "average goals, two decimals",
    "xg_per_match": "average chance quality over matches that have it, two decimals",
    "pen_shootouts": "shoot-outs counted",
    "champion": "first place",
    "runner_up": "second place",
    "top_scorer": "most goals of a player, as in the source",
    "wins_reg": "matches won by the score alone",
    "draws": "matches level by the score alone",
    "losses_reg": "matches lost by the score alone",
    "advanced_or_won": "matches of which the team is the winner",
    "goals_for": "goals the team made",
    "goals_against": "goals the team let in",
    "goal_diff": "goals made less goals let in",
    "xg_for": "chance quality the team made, in goals",
    "xg_against": "chance quality the team allowed, in goals",
    "attack_vs_xg": "goals made beyond chance quality made",
    "defense_vs_xg": "chance quality allowed beyond goals let in, so that more is better here too",
    "home_rank": "place of the first-named team in the ranking, 1 is best",
    "away_rank": "place of the second-named team in the ranking, 1 is best",
    "higher_ranked": "team with the better place; the second-named one where places are equal or missing",
    "favorite_won": "whether that team is the winner; empty if nobody is, false where places are equal or missing",
    "expected_home_goals": "model's mean goals of the first-named team",
    "expected_away_goals": "model's mean goals of the second-named team",
    "prob_home_win": "model's chance that the first-named team scores more",
    "prob_draw": "model's chance of equal scores",
    "prob_away_win": "model's chance that the second-named team scores more",
}

# What a reader has to know before drawing conclusions.
CAVEATS: tuple[str, ...] = (
    "An edition outside the configured years is nowhere in these tables.",
    "Only one played edition has rankings, so questions about favourites can be asked for that one alone.",
    "Chance quality is missing for some matches; sums and averages of it skip them, goal counts do not.",
    "A shoot-out decides who goes through but leaves the score level: result and winner can disagree.",
    "Rows without a winner are left out of favourite rates, not counted as failures.",
    "Few matches stand behind a team's figures; differences between neighbours mean little.",
    "Predictions come from a model of past editions and say nothing about lineups or form.",
    "The model knows no home advantage: first- and second-named are only places in the schedule.",
)

ALLOWED_TABLES: frozenset[str] = frozenset(PUBLISHED)


def data_dictionary(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """G3 as a DataFrame: (table, grain, position, column, type, description) of the
    published relations, from their own schemas."""
    rows = [
        (table, PUBLISHED[table], i, f.name, f.dataType.simpleString(), COLUMN_NOTES.get(f.name))
        for table, schema in schemas.items()
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, "table string, grain string, position int, column string, type string, description string")


def dictionary_profile(relations: Mapping[str, DataFrame]) -> DataFrame:
    """G3 with figures: (table, column, n_rows, n_known) of every documented column, one
    aggregate per relation."""
    parts = []
    for table, df in relations.items():
        if missing := undocumented(df.schema):
            raise ValueError(f"{table}: no note for {missing}")
        known = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(f"`{c}`").alias(f"k{i}") for i, c in enumerate(df.columns)])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"k{i}").alias("n_known")) for i, c in enumerate(df.columns)])
        parts.append(known.select(F.lit(table).alias("table"), "n_rows", F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_comments(df: DataFrame) -> DataFrame:
    """Attach the notes as column comments (kept in the Parquet schema)."""
    return df.select(
        *[
            F.col(f"`{f.name}`").alias(f.name, metadata={"comment": COLUMN_NOTES[f.name]}) if f.name in COLUMN_NOTES else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def undocumented(schema: T.StructType) -> list[str]:
    """Columns that the dictionary has no note for."""
    return [f.name for f in schema.fields if f.name not in COLUMN_NOTES]


# --------------------------------------------------------------- governed query


class QueryRejected(ValueError):
    """The statement broke a rule of the gate; the message is safe to show."""


class DeadlineExceeded(TimeoutError):
    """The statement was ended at its deadline."""


_FORBIDDEN_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})
_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical."
_ANALYSIS = "org.apache.spark.sql.catalyst.analysis."
_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."


def _seq(jseq) -> list:
    return [jseq.apply(i) for i in range(jseq.size())]


def _class_checker(jvm):
    cache: dict[str, object] = {}

    def is_a(obj, class_name: str) -> bool:
        if class_name not in cache:
            try:
                cache[class_name] = jvm.java.lang.Class.forName(class_name)
            except Exception:  # noqa: BLE001  (class absent in this Spark version)
                cache[class_name] = None
        cls = cache[class_name]
        return cls is not None and cls.isInstance(obj)

    return is_a


class _Gate:
    """Walks a parse tree with the common table expressions in scope at each node.

    A CTE name covers single-part relation names only, in the later definitions of
    its WITH and in the WITH's body; its own definition does not see it.
    """

    def __init__(self, spark: SparkSession, allowed: frozenset[str]):
        self.is_a = _class_checker(spark.sparkContext._jvm)
        self.allowed = {tuple(a.split(".")) for a in allowed}
        self.published = 0

    def relation(self, parts: tuple[str, ...], ctes: frozenset[str]) -> None:
        if len(parts) == 1 and parts[0] in ctes:
            return
        if parts not in self.allowed:
            raise QueryRejected(f"table not allowed: {'.'.join(parts)!r}; only published marts can be queried")
        self.published += 1

    def expression(self, e, ctes: frozenset[str]) -> None:
        if self.is_a(e, _EXPRESSIONS + "SubqueryExpression"):
            self.plan(e.plan(), ctes)
        if "UnresolvedIdentifier" in str(e.getClass().getSimpleName()):
            raise QueryRejected("dynamic identifiers are not allowed")
        if self.is_a(e, _ANALYSIS + "UnresolvedFunction"):
            name = ".".join(str(p) for p in _seq(e.nameParts())).lower()
            if name.rsplit(".", 1)[-1] in _FORBIDDEN_FUNCTIONS:
                raise QueryRejected(f"function not allowed: {name}")
        for child in _seq(e.children()):
            self.expression(child, ctes)

    def plan(self, node, ctes: frozenset[str]) -> None:
        if any(self.is_a(node, _LOGICAL + c) for c in ("Command", "ParsedStatement", "InsertIntoStatement")):
            raise QueryRejected("only read-only SELECT queries are allowed")
        if self.is_a(node, _ANALYSIS + "UnresolvedTableValuedFunction"):
            raise QueryRejected("table-valued functions are not allowed")
        kind = str(node.getClass().getSimpleName())
        if "UnresolvedIdentifier" in kind or "ExecuteImmediate" in kind:
            # IDENTIFIER('...') names a relation only at analysis time, and
            # EXECUTE IMMEDIATE runs a statement given as text: neither can be checked here
            raise QueryRejected("dynamic table names and statements are not allowed")
        if self.is_a(node, _LOGICAL + "UnresolvedWith"):
            for pair in _seq(node.cteRelations()):
                self.plan(pair._2(), ctes)
                ctes = ctes | {str(pair._1()).lower()}
            self.plan(node.child(), ctes)
            return
        if self.is_a(node, _ANALYSIS + "UnresolvedRelation"):
            self.relation(tuple(str(p).lower() for p in _seq(node.multipartIdentifier())), ctes)
        for child in _seq(node.children()):
            self.plan(child, ctes)
        for inner in _seq(node.innerChildren()):
            if self.is_a(inner, _LOGICAL + "LogicalPlan"):
                self.plan(inner, ctes)
        for e in _seq(node.expressions()):
            self.expression(e, ctes)

    def analysed(self, node) -> None:
        """Second check, on names as Spark resolved them: every leaf of the analysed plan
        is a published table, a CTE reference or a row of constants."""
        leaf = node.children().isEmpty()
        kind = str(node.getClass().getSimpleName())
        if leaf and kind not in ("OneRowRelation", "LocalRelation", "CTERelationRef"):
            table = node.catalogTable() if kind in ("LogicalRelation", "HiveTableRelation") else None
            known = table is not None and table.isDefined()
            ident = table.get().identifier() if known else None
            name = (str(ident.database().get()).lower() if ident.database().isDefined() else "", str(ident.table()).lower()) if known else ()
            if name not in self.allowed:
                raise QueryRejected(f"the query reads {'.'.join(name) or kind!r}, which is not published")
        for child in [*_seq(node.children()), *[p for p in _seq(node.innerChildren()) if self.is_a(p, _LOGICAL + "LogicalPlan")]]:
            self.analysed(child)
        for e in _seq(node.expressions()):
            self._analysed_expression(e)

    def _analysed_expression(self, e) -> None:
        if self.is_a(e, _EXPRESSIONS + "SubqueryExpression"):
            self.analysed(e.plan())
        for child in _seq(e.children()):
            self._analysed_expression(child)


def bounded_query(
    spark: SparkSession,
    sql: str,
    allowed: frozenset[str] = ALLOWED_TABLES,
    max_rows: int = config.MAX_ROWS_DEFAULT,
    max_bytes: int | None = None,
) -> DataFrame:
    """G1: validate, then run with a row cap (a smaller LIMIT inside is kept).

    CTEs are accepted and may be referenced where they are in scope; every other
    relation must be allow-listed, both as written and as analysed. Statements, DDL/DML, table-valued functions and
    reflective functions are rejected at any depth of the parse tree.

    ``max_bytes``: bound on Spark's size estimate of every step of the optimised plan, before anything
    runs. A row cap does not stop a join without a key, whose estimate is the product of its sides."""
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise QueryRejected("empty statement")
    gate = _Gate(spark, frozenset(a.lower() for a in allowed))
    try:
        root = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:  # noqa: BLE001
        raise QueryRejected("could not parse the statement as one SQL query") from e
    gate.plan(root, frozenset())
    if not gate.published:
        raise QueryRejected("the query must read a published table")
    df = spark.sql(text)  # a query: analysed, not run
    gate.analysed(df._jdf.queryExecution().analyzed())
    if max_bytes is not None and (most := _largest_step(df._jdf.queryExecution().optimizedPlan())) > max_bytes:
        raise QueryRejected(f"the query is too large: a step of it is estimated at {most:,} bytes, {max_bytes:,} are allowed")
    return df.limit(max_rows)


def _largest_step(plan) -> int:
    """The largest size estimate in an optimised plan."""
    own = int(str(plan.stats().sizeInBytes()))
    return max([own, *[_largest_step(c) for c in _seq(plan.children())]])


def run_bounded(
    spark: SparkSession,
    sql: str,
    allowed: frozenset[str] = ALLOWED_TABLES,
    max_rows: int = config.MAX_ROWS_DEFAULT,
    max_bytes: int | None = None,
    deadline: float = 60.0,
) -> tuple[list[str], list[Row]]:
    """G1 with a deadline: (columns, at most ``max_rows`` rows) of a statement that passes the gate.

    The statement's jobs carry a tag of their own. After ``deadline`` seconds the jobs with that
    tag are cancelled, and only those: other statements of the session go on."""
    df = bounded_query(spark, sql, allowed, max_rows, max_bytes)
    tag = f"governed-{uuid.uuid4().hex}"
    out: dict = {}

    def work() -> None:
        spark.sparkContext.addJobTag(tag)
        try:
            out["rows"] = df.collect()  # at most max_rows
        except Exception as e:  # noqa: BLE001  (handed to the caller)
            out["error"] = e
        finally:
            spark.sparkContext.removeJobTag(tag)

    thread = InheritableThread(target=work, daemon=True)
    thread.start()
    thread.join(deadline)
    if thread.is_alive():
        while thread.is_alive():  # a job that starts between two cancellations is met by the next
            spark.sparkContext.cancelJobsWithTag(tag)
            thread.join(0.2)
        if "rows" not in out:
            raise DeadlineExceeded(f"the statement was ended after {deadline:g} s")
    if "error" in out:
        raise out["error"]
    return df.columns, out["rows"]
