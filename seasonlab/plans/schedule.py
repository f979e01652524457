"""Schedules and standings from page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.functions import to_timestamp
from seasonlab.operators import conditional_swap, count_violations

# Names of playoff weeks and prefixes of conference header rows.
PLAYOFF_WEEKS = ["WildCard", "Division", "ConfChamp", "SuperBowl"]
CONFERENCES = ["AFC", "NFC"]
STANDING_COLUMNS = ["Tm", "W", "L", "T", "PF", "PA"]
TEAMS_PER_CONFERENCE = 16


def schedule(games: DataFrame, regular_only: bool = True) -> DataFrame:
    """Games with kick-off time and home and away team. Input columns: Week, Date,
    Time, winner, loser, at (set when the winner played away)."""
    dropped = ["Week", *(PLAYOFF_WEEKS if regular_only else [])]
    rows = games.where(F.col("Week").isNotNull() & ~F.col("Week").isin(dropped))
    rows = rows.withColumn("datetime", to_timestamp(F.col("Date"), F.col("Time")))
    return conditional_swap(rows, "at", "winner", "loser", ("home", "away")).select("Week", "home", "away", "datetime")


def standings(*conferences: DataFrame) -> DataFrame:
    """Conference tables stacked, without group headers and marks behind team names."""
    cleaned = []
    for table in conferences:
        header = F.col("Tm").startswith(CONFERENCES[0]) | F.col("Tm").startswith(CONFERENCES[1])
        cleaned.append(table.where(~header).withColumn("Tm", F.regexp_replace("Tm", r"[^a-zA-Z]*$", "")).select(*STANDING_COLUMNS))
    out = cleaned[0]
    for table in cleaned[1:]:
        out = out.unionByName(table)
    return out


def wrong_sizes(standing_tables: DataFrame, conference: str = "conference", expected: int = TEAMS_PER_CONFERENCE) -> DataFrame:
    """Conferences that do not have the expected number of teams."""
    return count_violations(standing_tables, [conference], expected)
