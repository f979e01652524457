"""Preparing draft rankings: names, teams and positions as the season tables spell them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.functions import Scoring, first_digits
from seasonlab.operators import apply_rules, blend_means, conditional_override, map_values

POSITIONS = ["QB", "RB", "TE", "WR"]

# Team codes of the ranking lists that differ from the season tables.
TEAM_CODES = {
    "GB": "GNB",
    "KC": "KAN",
    "LV": "LVR",
    "NE": "NWE",
    "NO": "NOR",
    "SF": "SFO",
    "TB": "TAM",
}

# Team, last season under the old code, old code.
OLD_TEAM_CODES = [("LVR", 2019, "OAK"), ("LAC", 2016, "SDG"), ("LAR", 2015, "STL")]

# Teams that were renamed and so may be seen for a short span.
RENAMED_TEAMS = ["LAC", "LAR", "LVR", "OAK", "SDG", "STL"]

# Initials written with dots.
INITIALS = {"CJ ": "C.J. ", "DJ ": "D.J. ", "DK ": "D.K. "}

# Whole names that differ.
FULL_NAMES = {
    "Steve Smith": "Steve Smith Sr.",
    "Marvin Jones Jr.": "Marvin Jones",
    "Darrell Henderson Jr.": "Darrell Henderson",
    "Gabe Davis": "Gabriel Davis",
}

# Part of a name, and the name used in the season tables.
NAME_PARTS = {
    "Trubisky": "Mitchell Trubisky",
    "Minshew": "Gardner Minshew II",
    "Chark": "DJ Chark",
    "Robert Griffin": "Robert Griffin III",
    "Willie Snead": "Willie Snead",
    "William Fuller": "Will Fuller",
    "Ronald Jones": "Ronald Jones II",
    "Benjamin Watson": "Ben Watson",
    "Rob Kelley": "Robert Kelley",
    "Henry Ruggs": "Henry Ruggs III",
    "Kenneth Walker": "Kenneth Walker III",
}

# Part of a name, and the position to use.
NAME_POSITIONS = {"Jordan Matthews": "WR", "Funchess": "WR"}

# Names to use when rankings meet the season table.
MERGE_NAMES = {
    "Robbie Anderson": "Chosen Anderson",
    "Travis Etienne Jr.": "Travis Etienne",
    "Joshua Palmer": "Josh Palmer",
    "Jeff Wilson Jr.": "Jeff Wilson",
    "J.J. Nelson": "JJ Nelson",
    "Brian Robinson": "Brian Robinson Jr.",
    "Scotty Miller": "Scott Miller",
}


def normalise_rankings(rankings: DataFrame) -> DataFrame:
    """Rankings with columns Name, Team, Position, PositionRank, Year in one spelling."""
    name = F.regexp_replace("Name", r"\s+I+\s*$", "")
    for old, new in INITIALS.items():
        name = F.replace(name, F.lit(old), F.lit(new))
    out = rankings.withColumn("PositionRank", first_digits("PositionRank")).withColumn("Name", name)
    out = map_values(out, "Name", FULL_NAMES).where(F.col("Position").isin(POSITIONS))
    out = map_values(out, "Team", TEAM_CODES)
    rules = [((F.col("Team") == team) & (F.col("Year") <= last), "Team", old) for team, last, old in OLD_TEAM_CODES]
    rules += [(F.col("Name").contains(part), "Position", pos) for part, pos in NAME_POSITIONS.items()]
    rules += [(F.col("Name").contains(part), "Name", full) for part, full in NAME_PARTS.items()]
    return conditional_override(out, rules)


def spelling_rules() -> list[tuple]:
    """The rules of :func:`normalise_rankings` as rows of a table, in three steps: initials
    and whole names, teams, then parts of names."""
    rules = [(0, "Name", "is", old, None, None, "Name", new) for old, new in FULL_NAMES.items()]
    rules += [(0, "Team", "is", old, None, None, "Team", new) for old, new in TEAM_CODES.items()]
    rules += [(1, "Team", "is", team, None, last, "Team", old) for team, last, old in OLD_TEAM_CODES]
    rules += [(1, "Name", "has", part, None, None, "Position", pos) for part, pos in NAME_POSITIONS.items()]
    rules += [(1, "Name", "has", part, None, None, "Name", full) for part, full in NAME_PARTS.items()]
    return [(step, n, field, *rest) for n, (step, field, *rest) in enumerate(rules)]


def normalise_by_rules(rankings: DataFrame, rules: DataFrame) -> DataFrame:
    """:func:`normalise_rankings` with its rules, and any others, as a table."""
    name = F.regexp_replace("Name", r"\s+I+\s*$", "")
    for old, new in INITIALS.items():
        name = F.replace(name, F.lit(old), F.lit(new))
    out = rankings.withColumn("PositionRank", first_digits("PositionRank")).withColumn("Name", name).where(F.col("Position").isin(POSITIONS))
    return apply_rules(out, rules, ["Name", "Team"], ["Name", "Team", "Position"], "Year", (0, 1))


def match_season_names(rankings: DataFrame) -> DataFrame:
    """Last differences before rankings are merged into the season table."""
    name, year = F.col("Name"), F.col("Year")
    return conditional_override(
        map_values(rankings, "Name", MERGE_NAMES),
        [
            ((name == "Cordarrelle Patterson") & (year < 2021), "Position", "WR"),
            ((name == "Ty Montgomery") & year.isin(2016, 2017, 2018), "Position", "RB"),
        ],
    )


def match_ranking_positions(points: DataFrame) -> DataFrame:
    """Positions of the season table that the rankings list differently."""
    return conditional_override(
        points,
        [
            (F.col("Player") == "Danny Woodhead", "FantPos", "RB"),
            (F.col("Player") == "Ladarius Green", "FantPos", "TE"),
        ],
    )


def rankings_for(scoring: Scoring, ppr: DataFrame, nppr: DataFrame, keys: list[str], dropped_years: tuple[int, ...] = (2014, 2015)) -> DataFrame:
    """Ranking list of a scoring variant; half weight is the blend of the two lists."""
    if scoring.name == "PPR":
        out = ppr
    elif scoring.name == "NPPR":
        out = nppr
    else:
        out = blend_means(ppr, nppr, keys, Scoring("PPR").ranking, Scoring("NPPR").ranking, scoring.ranking)
    return out.where(~F.col("Year").isin(list(dropped_years)))
