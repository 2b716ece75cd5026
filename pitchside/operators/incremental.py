"""Incremental state of the aggregate marts.

The marts are computed from sums per (team, year), (year, host) and (year, round) that can be
added up. ``MartState`` keeps those sums as a versioned table: a new batch of matches is reduced
and folded in, a replaced edition is taken out first, and no older match is read again. The state
grows with teams and editions, not with matches.

A batch has an id. Folding an id that the state holds changes nothing, so a restarted job may
fold again; the ids of a replaced edition are forgotten with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.operators import marts
from pitchside.sources.versions import KEEP, Version, Versions

KEYS = {"team": ("team", "year"), "edition": ("year", "host"), "knockout": ("year", "round")}
_MAXIMA = frozenset({"stage_order"})  # facts of the key, not sums


def reduced(stg_matches: DataFrame) -> dict[str, DataFrame]:
    """The sums of a batch of staged matches."""
    return {
        "team": marts.team_sums(marts.int_team_matches(stg_matches)),
        "edition": marts.edition_sums(stg_matches),
        "knockout": marts.knockout_sums(marts.int_match_stages(stg_matches)),
    }


def merged(name: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """Both frames of sums added up per key."""
    keys = KEYS[name]
    add = [(F.max if c in _MAXIMA else F.sum)(c).alias(c) for c in new.columns if c not in keys]
    return old.unionByName(new).groupBy(*keys).agg(*add)


class MartState:
    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP):
        self.versions = Versions(spark, root, keep)

    def batches(self) -> dict[str, list[int]]:
        """Batch id -> editions that it has a share in."""
        now = self.versions.version()
        return now.info["batches"] if now else {}

    def fold(self, stg_matches: DataFrame, batch: str, replace: Sequence[int] = ()) -> Version:
        """Add a batch of matches; ``replace``: editions that the batch replaces."""
        known = {b: [y for y in years if y not in replace] for b, years in self.batches().items()}
        known = {b: years for b, years in known.items() if years}
        if batch in known:
            if replace:
                raise ValueError(f"batch {batch!r} also has editions that are not replaced: {known[batch]}")
            return self.versions.version()
        new = reduced(stg_matches)
        if self.versions.version() is not None:
            old = self.versions.tables()
            new = {n: merged(n, old[n].where(~F.coalesce(F.col("year").isin([int(y) for y in replace]), F.lit(False))), df) for n, df in new.items()}
        years = [r["year"] for r in stg_matches.select("year").distinct().collect()]  # one row per edition
        return self.versions.write(new, {"batches": known | {batch: sorted(y for y in years if y is not None)}})

    def marts(self, stg_world_cup: DataFrame) -> dict[str, DataFrame]:
        """A1 to A4 from the current sums; A14 reads ``team_strength_inputs``."""
        sums = self.versions.tables()
        performance = marts.performance_of(sums["team"])
        return {
            "edition_kpis": marts.kpis_of(sums["edition"], stg_world_cup),
            "knockout_analysis": marts.knockout_of(sums["knockout"]),
            "team_performance": performance,
            "team_strength_inputs": marts.team_strength_inputs(performance),
        }
