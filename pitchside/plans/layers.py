"""The layered model (S10): seeds -> staging -> marts as one lazy lineage.

The reference builds its layers in a fixed order of SQL files; here each
layer is a property that composes DataFrames, so the dependency order is the
lineage itself and nothing is computed until an action needs it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.config import DEFAULT_SCOPE, Scope
from pitchside.operators import marts, staging
from pitchside.sources import bridge, store
from pitchside.sources.bridge import RawTables


# relation -> property, each after those that it reads
LAYERS = {
    "stg.matches": "stg_matches",
    "mart.int_match_stages": "int_match_stages",
    "mart.int_team_matches": "int_team_matches",
    "mart.team_performance": "team_performance",
    "mart.team_strength_inputs": "team_strength_inputs",
    "mart.edition_kpis": "edition_kpis",
    "mart.knockout_analysis": "knockout_analysis",
    "mart.ranking_vs_result": "ranking_vs_result",
}


class Warehouse:
    def __init__(self, raw: RawTables | bridge.LazyRawTables, scope: Scope = DEFAULT_SCOPE):
        self.raw = raw
        self.scope = scope

    @classmethod
    def from_star(
        cls, spark: SparkSession, sf_dir: str, scope: Scope = DEFAULT_SCOPE, materialize: bool = False
    ) -> Warehouse:
        """Layers over the star-schema bridge; the scan of orders is pruned to
        the scope years. With ``materialize`` the scoped raw match table is
        written once (like the reference's raw tables) so that plans with
        many branches over it (model, back-test) read files instead of
        re-running the bridge joins once per branch."""
        raw = bridge.load_raw(spark, sf_dir, years=scope.years)
        if materialize:
            raw.matches = store.materialize(raw.matches, "raw_matches")
        return cls(raw, scope)

    # seeds
    @property
    def crosswalk(self) -> DataFrame:
        return self.raw.crosswalk

    # staging
    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw.matches, self.scope.years)

    @cached_property
    def stg_world_cup(self) -> DataFrame:
        return staging.stg_world_cup(self.raw.world_cup, self.scope.years)

    @cached_property
    def stg_rankings(self) -> DataFrame:
        return staging.stg_rankings([(self.raw.rankings[s.table], s) for s in self.scope.snapshots])

    # marts
    @cached_property
    def int_match_stages(self) -> DataFrame:
        return marts.int_match_stages(self.stg_matches)

    @cached_property
    def int_team_matches(self) -> DataFrame:
        return marts.int_team_matches(self.stg_matches)

    @cached_property
    def team_performance(self) -> DataFrame:
        return marts.team_performance(self.int_team_matches)

    @cached_property
    def team_strength_inputs(self) -> DataFrame:
        return marts.team_strength_inputs(self.team_performance)

    @cached_property
    def edition_kpis(self) -> DataFrame:
        return marts.edition_kpis(self.stg_matches, self.stg_world_cup)

    @cached_property
    def knockout_analysis(self) -> DataFrame:
        return marts.knockout_analysis(self.int_match_stages)

    @cached_property
    def ranking_vs_result(self) -> DataFrame:
        return marts.ranking_vs_result(
            self.stg_matches, self.stg_rankings, self.crosswalk, self.scope.test_year, self.scope.test_cycle
        )

    # registry used by the layer summary, publishing and the governed entry point
    def relations(self) -> dict[str, DataFrame]:
        return {
            "stg.matches": self.stg_matches,
            "mart.int_team_matches": self.int_team_matches,
            "mart.team_performance": self.team_performance,
            "mart.team_strength_inputs": self.team_strength_inputs,
            "mart.edition_kpis": self.edition_kpis,
            "mart.knockout_analysis": self.knockout_analysis,
            "mart.ranking_vs_result": self.ranking_vs_result,
        }

    def write_layers(self, path, comments=lambda df: df) -> dict[str, int]:
        """Write every layer under ``path(name)``, each from the files of those before it, and go on
        with the files. Returns row counts, taken by the tasks that write."""
        counts = {}
        for name, attribute in LAYERS.items():
            counts[name] = store.write_observed(comments(getattr(self, attribute)), path(name))["n_rows"]
            self.use_layers({name: path(name)})
        return counts

    def use_layers(self, paths: dict[str, str]) -> None:
        """Read layers from files instead of deriving them."""
        spark = self.crosswalk.sparkSession
        for name, path in paths.items():
            self.__dict__[LAYERS[name]] = spark.read.parquet(path)

    def with_written_matches(self, cols: Sequence[str]) -> Warehouse:
        """The same layers over these columns of stg.matches, written once: relations that are
        written one by one do not join the raw matches again each time, and columns that none of
        them reads take no part in that join."""
        out = Warehouse(self.raw, self.scope)
        out.__dict__["stg_matches"] = store.materialize(self.stg_matches.select(*cols), "stg_matches")
        return out

    def layer_counts(self) -> DataFrame:
        """Row count of each relation, as one DataFrame (one job)."""
        parts = [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("relation"), "n_rows")
            for name, df in self.relations().items()
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
