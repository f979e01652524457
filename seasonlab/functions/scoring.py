"""Linear scoring of stat columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Points per stat; receptions are weighted by the scoring variant.
POINTS_PER_STAT = {
    "PassYds": 0.04,
    "PassTD": 4,
    "PassInt": -2,
    "RushYds": 0.1,
    "RushTD": 6,
    "RecYds": 0.1,
    "RecTD": 6,
    "FL": -2,
    "2PM": 2,
    "2PP": 2,
}

# Weight of one reception and name of the ranking column per variant.
VARIANTS = {
    "PPR": (1.0, "AverageDraftPositionPPR"),
    "HPPR": (0.5, "AverageDraftPositionHPPR"),
    "NPPR": (0.0, "AverageDraftPosition"),
}


@dataclass(frozen=True)
class Scoring:
    """A scoring variant and the column names that follow from it."""

    name: str = "HPPR"

    def __post_init__(self) -> None:
        if self.name not in VARIANTS:
            raise ValueError(f"unknown scoring variant {self.name!r}")

    @property
    def rec_weight(self) -> float:
        return VARIANTS[self.name][0]

    @property
    def points(self) -> str:
        return f"Pts_{self.name}"

    @property
    def ranking(self) -> str:
        return VARIANTS[self.name][1]

    @property
    def weights(self) -> dict[str, float]:
        return {**POINTS_PER_STAT, "Rec": self.rec_weight}


def linear_score(weights: dict[str, float]) -> Column:
    """Weighted sum of the columns; a null stat counts as 0."""
    terms = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def add_score(df: DataFrame, weights: dict[str, float], name: str) -> DataFrame:
    return df.withColumn(name, linear_score(weights))


def score_violations(df: DataFrame, score: str, published: str, tolerance: float = 0.1) -> DataFrame:
    """Rows whose score exceeds the published one by more than the tolerance."""
    return df.where(F.col(score) - F.col(published) > tolerance)


def score_season_stats(stats: DataFrame, scoring: Scoring) -> DataFrame:
    """Season stat rows as read from a page: drop repeated headers, convert,
    score, clean the names and keep rows that have a position."""
    numeric = [*scoring.weights, "FantPt", "PPR"]
    parsed = stats.where(~F.col("Player").eqNullSafe("Player")).drop("Rk")
    parsed = parsed.withColumns({c: F.col(f"`{c}`").cast("double") for c in numeric})
    return (
        parsed.fillna({c: 0.0 for c in scoring.weights})
        .withColumn(scoring.points, linear_score(scoring.weights))
        .withColumn("Player", F.trim(F.regexp_replace("Player", r"[*+]", "")))
        .where(F.col("FantPos").isNotNull())
    )
