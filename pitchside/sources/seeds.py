"""Seed tables (S6): small, hand-kept mappings that ship with the code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchside.sources.schemas import CROSSWALK

# Name pairs (match file name -> ranking file name) of the
# bridge data, where the ranking source spells three teams differently.
BRIDGE_CROSSWALK: tuple[tuple[str, str], ...] = (
    ("NATION_0", "N0"),
    ("NATION_1", "N1"),
    ("NATION_2", "N2"),
)


def team_crosswalk(spark: SparkSession, pairs: tuple[tuple[str, str], ...] = BRIDGE_CROSSWALK) -> DataFrame:
    """The crosswalk as a DataFrame. One row per ``match_name`` is required:
    a duplicate would fan out every reconciled row, so it is refused here."""
    names = [m for m, _ in pairs]
    if len(set(names)) != len(names):
        raise ValueError("team crosswalk has duplicate match_name entries")
    return spark.createDataFrame(list(pairs), CROSSWALK)
