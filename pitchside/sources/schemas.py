"""Explicit schemas of the raw inputs.

The raw layer is read with these schemas (no inference pass over the files).
Column names are those of the source files, including their quirks (a
hyphenated ``Runner-Up`` and the misspelt ``TopScorrer``); staging renames them.
"""

from __future__ import annotations

from pyspark.sql import types as T

MATCHES = T.StructType(
    [
        T.StructField("Year", T.LongType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Host", T.StringType()),
        T.StructField("Round", T.StringType()),
        T.StructField("Venue", T.StringType()),
        T.StructField("Attendance", T.LongType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
        T.StructField("home_xg", T.DoubleType()),
        T.StructField("away_xg", T.DoubleType()),
        T.StructField("home_penalty", T.LongType()),
        T.StructField("away_penalty", T.LongType()),
        T.StructField("home_manager", T.StringType()),
        T.StructField("away_manager", T.StringType()),
        T.StructField("home_captain", T.StringType()),
        T.StructField("away_captain", T.StringType()),
        T.StructField("Referee", T.StringType()),
        T.StructField("Notes", T.StringType()),
    ]
)

WORLD_CUP = T.StructType(
    [
        T.StructField("Year", T.LongType()),
        T.StructField("Host", T.StringType()),
        T.StructField("Teams", T.LongType()),
        T.StructField("Champion", T.StringType()),
        T.StructField("Runner-Up", T.StringType()),
        T.StructField("TopScorrer", T.StringType()),
        T.StructField("Attendance", T.LongType()),
        T.StructField("AttendanceAvg", T.DoubleType()),
        T.StructField("Matches", T.LongType()),
    ]
)

SCHEDULE = T.StructType(
    [
        T.StructField("Round", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("Notes", T.StringType()),
    ]
)

_RANKING_FIELDS = [
    T.StructField("team", T.StringType()),
    T.StructField("team_code", T.StringType()),
    T.StructField("association", T.StringType()),
    T.StructField("rank", T.LongType()),
    T.StructField("previous_rank", T.LongType()),
    T.StructField("points", T.DoubleType()),
    T.StructField("previous_points", T.DoubleType()),
]
RANKING = T.StructType(list(_RANKING_FIELDS))
RANKING_RATED = T.StructType([*_RANKING_FIELDS, T.StructField("rated_matches", T.LongType())])

CROSSWALK = T.StructType(
    [
        T.StructField("match_name", T.StringType()),
        T.StructField("ranking_name", T.StringType()),
    ]
)

# Raw source registry: logical table -> (file name, schema).
RAW_SOURCES: dict[str, tuple[str, T.StructType]] = {
    "matches": ("matches.csv", MATCHES),
    "world_cup": ("world_cup.csv", WORLD_CUP),
    "schedule": ("schedule.csv", SCHEDULE),
    "ranking_old": ("ranking_old.csv", RANKING),
    "ranking_new": ("ranking_new.csv", RANKING_RATED),
}
