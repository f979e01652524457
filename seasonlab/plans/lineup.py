"""Best possible lineups from weekly scores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.functions import amount, parse_number
from seasonlab.operators import join_to_groups, nth_best, top_n, union_missing

FLEX = "FLEX"


@dataclass(frozen=True)
class Slots:
    """Starters per position, and positions that may fill the one flex slot."""

    quotas: dict[str, int] = field(default_factory=lambda: {"QB": 1, "RB": 2, "WR": 2, "TE": 1})
    flex: tuple[str, ...] = ("RB", "WR", "TE")

    @property
    def positions(self) -> list[str]:
        return list(self.quotas)

    def quota(self, pos: str) -> Column:
        """Quota of a row's position, 0 for a position without a slot."""
        table = F.create_map(*[F.lit(x) for kv in self.quotas.items() for x in kv])
        return F.coalesce(F.try_element_at(table, F.col(pos)), F.lit(0))


# The place in the undrafted order that stands for a freely available player.
REPLACEMENT_PLACES = {"QB": 5, "RB": 10, "WR": 10, "TE": 5}


def replacement_points(undrafted: DataFrame, score: str, key: str, pos: str = "pos", places: dict[str, int] | None = None) -> DataFrame:
    """Season score of the nth best undrafted entity per position: columns pos, points."""
    best = nth_best(undrafted, pos, [(score, False), (key, True)], places or REPLACEMENT_PLACES)
    return best.select(F.col(pos).alias("pos"), F.col(score).alias("points"))


def baseline_grid(teams: DataFrame, baselines: DataFrame, weeks: int = 18) -> DataFrame:
    """One replacement row per week, team and position, the season score spread evenly.

    ``baselines`` has one row per declared position, so it travels as one array value.
    """
    spread = baselines.agg(F.collect_list(F.struct("pos", "points"))).scalar()
    rows = teams.select("team", F.explode(spread).alias("_b"))
    return rows.select(
        F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("week"),
        "team",
        F.col("_b.pos").alias("pos"),
        (F.col("_b.points").cast("double") / weeks).alias("pts"),
        F.concat(F.lit("baseline"), "_b.pos").alias("player"),
    )


def weekly_scores(weekly: DataFrame, drafted: DataFrame, baselines: DataFrame, rec_weight: float, baseline_as_zero: bool = False) -> DataFrame:
    """Scores per week of drafted players, with every replacement row twice.

    ``weekly`` (player_id, week, fant_pt, rec) may hold text; what does not parse
    counts as 0. At most two replacements can start at one position.
    """
    chosen = join_to_groups(weekly, drafted.select("player_id", "team", "pos"), ["player_id"], "inner")
    number = {c: F.coalesce(parse_number(c), F.lit(0.0)) for c in ("fant_pt", "rec")}
    chosen = chosen.withColumn("week", F.coalesce(parse_number("week"), F.lit(0.0)).cast("int")).withColumns(number)
    scored = chosen.select(
        "week", "team", "pos", F.col("player_id"), (F.col("fant_pt") + F.lit(float(rec_weight)) * F.col("rec")).alias("pts")
    )
    pts = F.lit(0.0) if baseline_as_zero else F.col("pts")
    spare = baselines.select("week", "team", "pos", "player", pts.alias("pts"))
    return union_missing(scored, spare, spare)


def starters(weekly: DataFrame, slots: Slots, by: list[str], score: str, tie: list[str]) -> DataFrame:
    """Rows that start: quota best per position, then the best leftover as flex.

    A flex candidate is the first row beyond its position's quota, so no more than
    quota + 1 rows per group ever leave a map task.
    """
    order = [(score, False), *[(t, True) for t in tie]]
    listed = weekly.where(F.col("pos").isin(slots.positions))
    best = top_n(listed, [*by, "pos"], order, max(slots.quotas.values()) + 1)
    quota = slots.quota("pos")
    filled = best.where(F.col("rn") <= quota).withColumn("slot", F.col("pos"))
    spare = best.where((F.col("rn") == quota + 1) & F.col("pos").isin(list(slots.flex))).drop("rn")
    flex = top_n(spare, by, order + [("pos", True)], 1).withColumn("slot", F.lit(FLEX))
    return filled.unionByName(flex)


def best_lineup(weekly: DataFrame, slots: Slots, by: tuple[str, ...] = ("week",), score: str = "pts", tie: tuple[str, ...] = ("player_id",), weeks: int = 18) -> DataFrame:
    """Points per team and slot of the best lineup of every week, per week of the season."""
    lineup = starters(weekly, slots, [*by, "team"], score, list(tie))
    total = F.sum(amount(score)).cast("double")
    return lineup.groupBy("team", F.col("slot").alias("pos")).agg((total / weeks).alias(score))
