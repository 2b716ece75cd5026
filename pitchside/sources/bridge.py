"""Bridge from the star-schema test tables to the pipeline's raw inputs.

The driver's data is a TPC-H-like star schema; it holds no matches. This
module derives the five raw inputs of the pipeline from it, so every query
runs over the whole given tables and its work grows with them:

* a line item is a match between the customer's nation (home) and the
  supplier's nation (away); lines whose two nations are equal are dropped;
* edition facts come from the orders of each year;
* two ranking snapshots come from nations (with history) and regions
  (teams that never play, i.e. cold starts);
* the future schedule pairs each nation with its region and with the next
  nation, both by equi-join.

The mapping itself is data preparation, not an operator of the library.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.sources import seeds

STAR_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

# Fixed values of the bridge: round name by line number.
ROUND_BY_LINE: tuple[tuple[int, str], ...] = (
    (1, "Group stage"),
    (2, "Group stage"),
    (3, "Round of 16"),
    (4, "Quarter-finals"),
    (5, "Semi-finals"),
    (6, "Third-place match"),
    (7, "Final"),
)
SCHEDULE_START = dt.date(2002, 6, 11)


@dataclass
class RawTables:
    """The raw layer: lazily defined DataFrames, nothing materialised."""

    matches: DataFrame
    world_cup: DataFrame
    schedule: DataFrame
    rankings: dict[str, DataFrame]
    crosswalk: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)


class StarTables(dict):
    """The star tables of one folder, each opened on first use (a query that
    needs three tables lists and opens three files)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise KeyError(name)
        self[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self[name]


def read_star(spark: SparkSession, sf_dir: str) -> StarTables:
    return StarTables(spark, sf_dir)


def _years_sql(years: tuple[int, ...] | None) -> str:
    """``o_orderdate`` ranges for the scope years, as SQL text (years are ints)."""
    if not years:
        return "TRUE"
    ranges = [
        f"(o_orderdate >= TIMESTAMP_NTZ '{int(y)}-01-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ '{int(y) + 1}-01-01 00:00:00')"
        for y in sorted(set(years))
    ]
    return " OR ".join(ranges)


def _rounds_sql(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {n} THEN '{name}'" for n, name in ROUND_BY_LINE) + " END"


_MATCHES_SQL = """
SELECT
    CAST(year(o.o_orderdate) AS BIGINT)                                  AS Year,
    CAST(o.o_orderdate AS DATE)                                          AS Date,
    concat('HOST_', CAST(CAST(year(o.o_orderdate) AS BIGINT) AS STRING)) AS Host,
    {rounds}                                                             AS Round,
    o.o_orderpriority                                                    AS Venue,
    CAST(floor(l.l_extendedprice) AS BIGINT)                             AS Attendance,
    hn.n_name                                                            AS home_team,
    an.n_name                                                            AS away_team,
    CAST(l.l_quantity AS BIGINT) % 5                                     AS home_score,
    l.l_partkey % 4                                                      AS away_score,
    CASE WHEN l.l_tax < 0.08D THEN l.l_discount * 20 END                 AS home_xg,
    CASE WHEN l.l_tax < 0.08D THEN l.l_tax * 25 END                      AS away_xg,
    CAST(CASE WHEN l.l_linenumber >= 3 AND CAST(l.l_quantity AS BIGINT) % 5 = l.l_partkey % 4
              THEN CASE WHEN (l.l_orderkey + l.l_linenumber) % 2 = 0 THEN 5 ELSE 3 END END AS BIGINT)
                                                                         AS home_penalty,
    CAST(CASE WHEN l.l_linenumber >= 3 AND CAST(l.l_quantity AS BIGINT) % 5 = l.l_partkey % 4
              THEN 4 END AS BIGINT)                                      AS away_penalty,
    c.c_name                                                             AS home_manager,
    s.s_name                                                             AS away_manager,
    CAST(NULL AS STRING)                                                 AS home_captain,
    CAST(NULL AS STRING)                                                 AS away_captain,
    concat('REF_', CAST(l.l_orderkey % 97 AS STRING))                    AS Referee,
    o.o_orderstatus                                                      AS Notes
FROM {{lineitem}} l
JOIN (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus
      FROM {{orders}} WHERE {years}) o ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} hn ON c.c_nationkey = hn.n_nationkey
JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
JOIN {{nation}} an ON s.s_nationkey = an.n_nationkey
WHERE c.c_nationkey <> s.s_nationkey
"""


def raw_matches(star: dict[str, DataFrame], years: tuple[int, ...] | None = None) -> DataFrame:
    """One row per match with the column names of the raw match file.

    ``years`` only prunes the scan of orders (date ranges the Parquet reader
    can use); it never changes a value. One SQL statement over the star
    DataFrames: parsed and analysed once."""
    spark = star["lineitem"].sparkSession
    text = _MATCHES_SQL.format(rounds=_rounds_sql("l.l_linenumber"), years=_years_sql(years))
    return spark.sql(
        text,
        lineitem=star["lineitem"], orders=star["orders"], customer=star["customer"],
        nation=star["nation"], supplier=star["supplier"],
    )


def raw_world_cup(star: dict[str, DataFrame], years: tuple[int, ...] | None = None) -> DataFrame:
    """One row per year of orders (an edition). ``years`` prunes the scan of
    orders to those years (the same date ranges as the match table)."""
    year = F.year("o_orderdate").cast("bigint")
    orders = star["orders"].select("o_orderdate", "o_totalprice")
    if years:
        orders = orders.where(F.expr(_years_sql(years)))
    per_year = orders.groupBy(year.alias("Year")).agg(
        F.count(F.lit(1)).alias("Matches"),
        F.sum(F.floor("o_totalprice")).cast("bigint").alias("Attendance"),
        F.avg(F.floor("o_totalprice")).alias("AttendanceAvg"),
    )
    y = F.col("Year")
    return per_year.select(
        "Year",
        F.concat(F.lit("HOST_"), y.cast("string")).alias("Host"),
        F.lit(32).cast("bigint").alias("Teams"),
        F.concat(F.lit("NATION_"), (y % 25).cast("string")).alias("Champion"),
        F.concat(F.lit("NATION_"), ((y + 1) % 25).cast("string")).alias("Runner-Up"),
        F.concat(F.lit("NATION_"), ((y + 2) % 25).cast("string"), F.lit(" - "), (y % 7 + 3).cast("string")).alias(
            "TopScorrer"
        ),
        "Attendance",
        "AttendanceAvg",
        "Matches",
    )


# Ranking rules per snapshot: (rank, previous rank, points, previous points,
# rated matches) for nations (n = nation key) and regions (r = region key).
# The first three nations are spelt differently in the ranking source
# (see the crosswalk seed).
_RANKING_RULES = {
    "ranking_old": (
        ("(n * 7) % 25 + 1", "(n * 3) % 25 + 1", "1000 + n * 30", "1000 + n * 30 - 15", None),
        ("r + 26", "r + 26", "900 - r * 10", "900 - r * 10", None),
    ),
    "ranking_new": (
        ("(n * 11) % 25 + 1", "(n * 7) % 25 + 1", "1010 + ((n * 13) % 25) * 28", "1000 + n * 30", "n + 20"),
        ("r + 26", "r + 26", "880 - r * 12", "900 - r * 10", "r + 8"),
    ),
}
_RANKING_COLS = (("rank", "BIGINT"), ("previous_rank", "BIGINT"), ("points", "DOUBLE"),
                 ("previous_points", "DOUBLE"), ("rated_matches", "BIGINT"))


def _ranking_cols(rules: tuple[str | None, ...]) -> str:
    return ", ".join(
        f"CAST({expr} AS {typ}) AS {name}" for expr, (name, typ) in zip(rules, _RANKING_COLS) if expr is not None
    )


def raw_ranking(star: dict[str, DataFrame], which: str) -> DataFrame:
    """Ranking snapshot ``ranking_old`` or ``ranking_new``: nations, then regions."""
    if which not in _RANKING_RULES:
        raise ValueError(f"unknown ranking snapshot {which!r}")
    nations, regions = _RANKING_RULES[which]
    text = f"""
        SELECT CASE WHEN n < 3 THEN concat('N', CAST(n AS STRING)) ELSE n_name END AS team,
               concat('T', lpad(CAST(n AS STRING), 2, '0')) AS team_code,
               r_name AS association, {_ranking_cols(nations)}
        FROM (SELECT n_nationkey AS n, n_name, n_regionkey FROM {{nation}}) x
        JOIN {{region}} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT r_name, concat('R', CAST(r AS STRING)), r_name, {_ranking_cols(regions)}
        FROM (SELECT r_regionkey AS r, r_name FROM {{region}}) y
    """
    return star["nation"].sparkSession.sql(text, nation=star["nation"], region=star["region"])


_SCHEDULE_SQL = """
    SELECT 'Group stage' AS Round, date_add(DATE '{start}', CAST(n.n_nationkey % 14 AS INT)) AS Date,
           n.n_name AS home_team, r.r_name AS away_team, CAST(NULL AS STRING) AS Notes
    FROM {{nation}} n JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
    UNION ALL
    SELECT 'Group stage', date_add(DATE '{start}', CAST((n.n_nationkey + 7) % 14 AS INT)),
           n.n_name, m.n_name, CAST(NULL AS STRING)
    FROM {{nation}} n JOIN {{nation}} m ON m.n_nationkey = n.n_nationkey + 1
"""


def raw_schedule(star: dict[str, DataFrame]) -> DataFrame:
    """Future fixtures: each nation against its region (a cold-start team)
    and against the next nation key (both equi-joins)."""
    text = _SCHEDULE_SQL.format(start=SCHEDULE_START.isoformat())
    return star["nation"].sparkSession.sql(text, nation=star["nation"], region=star["region"])


class LazyRawTables:
    """The raw layer over the star tables; each input is defined on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None, star: StarTables | None = None):
        self.spark = spark
        self.star = read_star(spark, sf_dir) if star is None else star
        self.years = years
        self.extra: dict[str, DataFrame] = {}

    @cached_property
    def matches(self) -> DataFrame:
        return raw_matches(self.star, self.years)

    @cached_property
    def world_cup(self) -> DataFrame:
        return raw_world_cup(self.star, self.years)

    @cached_property
    def schedule(self) -> DataFrame:
        return raw_schedule(self.star)

    @cached_property
    def rankings(self) -> dict[str, DataFrame]:
        return {name: raw_ranking(self.star, name) for name in ("ranking_old", "ranking_new")}

    @cached_property
    def crosswalk(self) -> DataFrame:
        return seeds.team_crosswalk(self.spark)


def load_raw(spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None, star: StarTables | None = None) -> LazyRawTables:
    """The raw layer derived from the star tables under ``sf_dir`` (or from ``star``: see ``colocated``)."""
    return LazyRawTables(spark, sf_dir, years, star)
