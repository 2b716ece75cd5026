"""Parameters of the pipeline.

Everything the reference hard-codes (scope years, ranking cycles, the stage
map, shrinkage weight, clip bounds, grid truncation) is a field here, so the
same operators run on any head-to-head data set. Defaults are set for the
star-schema bridge in :mod:`pitchside.sources.bridge` (train 1998, test 2000).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference for identical results.
# Stage names and their chronological order (1 = group stage ... 6 = final).
STAGE_ORDER: tuple[tuple[str, int], ...] = (
    ("Group stage", 1),
    ("Round of 16", 2),
    ("Quarter-finals", 3),
    ("Semi-finals", 4),
    ("Third-place match", 5),
    ("Final", 6),
)
GROUP_STAGE = "Group stage"
# Prior weight of the shrinkage, in equivalent matches.
SHRINKAGE_K = 3.0
# Weight of real goals in the goal/xG blend.
BLEND_WEIGHT = 0.5
# Bounds of the regression fallback for teams without history.
ATTACK_CLIP = (0.4, 1.6)
DEFENSE_CLIP = (0.5, 2.0)
# The joint score grid is truncated at this many goals per side and renormalised.
MAX_GOALS = 8
# Floor of the probability inside the log-loss.
LOG_LOSS_EPS = 1e-12
# Row cap of the governed SQL entry point.
MAX_ROWS_DEFAULT = 200
# Bootstrap defaults.
BOOTSTRAP_RESAMPLES = 1000
BOOTSTRAP_SEED = 12345
BOOTSTRAP_PERCENTILES = (5.0, 95.0)
# Sweep grid.
SWEEP_K_GRID = (1.0, 2.0, 3.0, 5.0, 8.0)
SWEEP_BLEND_GRID = (0.0, 0.25, 0.5, 0.75, 1.0)
# Minimum matches of the efficiency views.
MIN_MATCHES_TOP = 4
MIN_MATCHES_TABLE = 5


@dataclass(frozen=True)
class RankingSnapshot:
    """One ranking file: which raw table, which cycle, which snapshot date."""

    table: str
    cycle: int
    snapshot_date: dt.date
    has_rated_matches: bool


@dataclass(frozen=True)
class Scope:
    """Which editions are in scope and how they are used by the model."""

    years: tuple[int, ...] = (1998, 2000)
    train_years: tuple[int, ...] = (1998,)
    test_year: int = 2000
    test_cycle: int = 2000
    predict_cycle: int = 2002
    snapshots: tuple[RankingSnapshot, ...] = field(
        default_factory=lambda: (
            RankingSnapshot("ranking_old", 2000, dt.date(2000, 10, 6), False),
            RankingSnapshot("ranking_new", 2002, dt.date(2002, 6, 8), True),
        )
    )


DEFAULT_SCOPE = Scope()
