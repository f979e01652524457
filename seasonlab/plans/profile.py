"""What a team's roster looks like: best members, depth, and features built on them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.functions import amount
from seasonlab.operators import drop_bad_groups, join_to_groups, pivot_values, top_n
from seasonlab.plans.lineup import FLEX, Slots

# What stands for a missing member's prediction and its error.
NO_POINTS = 0.0
NO_MEMBER_ERROR = 10000.0

MEASURES = [
    "a_pred_points",
    "a_std_error",
    "b_pred_points",
    "b_std_error",
    "num_others",
    "avg_pred_points_other",
    "avg_std_error_other",
]
FLEX_STARTERS = 2


def group_profile(members: DataFrame, slots: Slots, by: tuple[str, ...] = ("league", "team"), pred: str = "pred", error: str = "var_pred", key: str = "player_id") -> DataFrame:
    """First and second best member, number of others and their averages, for every
    position and for the flex group (what is left after each position's starters).

    Per (team, position) only the sums and the few best rows are kept: both are cut
    down in the map tasks, and the rest follows from sums minus starters. Positions a
    team lacks appear with their defaults.
    """
    by = list(by)
    depth = _position_depth(members, slots, by, pred, error, key, FLEX_STARTERS)
    per_team = depth.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("pos", "depth"))).alias("_all"))
    groups = {p: F.try_element_at("_all", F.lit(p)) for p in slots.positions}
    per_team = per_team.withColumns({f"_{p}": g for p, g in groups.items()})
    rows = [_position_row(p, F.col(f"_{p}"), q) for p, q in slots.quotas.items()] + [_flex_row(slots)]
    return per_team.select(*by, F.inline(F.array(*rows)))


def value_added(candidates: DataFrame, members: DataFrame, slots: Slots, predict: Callable[[DataFrame], DataFrame], by: tuple[str, ...] = ("league",), pred: str = "pred", error: str = "var_pred", key: str = "player_id") -> DataFrame:
    """How much a candidate would add to the prediction of its position.

    ``members`` are those already chosen by the one team per league that is on the
    clock. The candidate is put into the position's few best rows and sums, so the
    team's members are not repeated per candidate.
    """
    by = list(by)
    depth = _position_depth(members, slots, by, pred, error, key, 0)
    rows = join_to_groups(candidates.where(F.col("pos").isin(slots.positions)), depth, [*by, "pos"])
    now, new = F.col("depth"), _member(pred, error, key)
    joined = F.struct(
        (F.coalesce(now["n"], F.lit(0)) + 1).alias("n"),
        *[(_zero(now[c]) + new[c]).alias(c) for c in ("p", "e")],
        *[(F.coalesce(now[c], F.lit(0)) + new[c]).alias(c) for c in ("cp", "ce")],
        F.sort_array(F.concat(F.coalesce(now["top"], F.array()), F.array(new))).alias("top"),
    )
    rows = rows.withColumn("_with", joined)
    for name in ("depth", "_with"):
        per_pos = [F.when(F.col("pos") == p, _position_row(p, F.col(name), q)) for p, q in slots.quotas.items()]
        rows = rows.withColumn(f"_row{name}", F.coalesce(*per_pos))
    keep = candidates.columns
    for name, result in (("depth", "_before"), ("_with", "_after")):
        measured = rows.select("*", *[F.col(f"_row{name}")[m].alias(m) for m in MEASURES])
        rows = predict(measured).withColumnRenamed("prediction", result).drop(*MEASURES)
    return rows.withColumn("value_add", F.col("_after") - F.col("_before")).select(*keep, "value_add")


def _member(pred: str, error: str, key: str) -> Column:
    """A member as a value that sorts best first."""
    return F.struct(
        F.col(pred).isNull().alias("unknown"),
        (-F.col(pred).cast("double")).alias("order"),
        F.col(key).alias("id"),
        F.col(pred).cast("double").alias("pred"),
        F.col(error).cast("double").alias("error"),
        _zero(amount(pred)).alias("p"),
        _zero(amount(error)).alias("e"),
        F.col(pred).isNotNull().cast("long").alias("cp"),
        F.col(error).isNotNull().cast("long").alias("ce"),
    )


def _position_depth(members: DataFrame, slots: Slots, by: list[str], pred: str, error: str, key: str, beyond: int) -> DataFrame:
    """Size, sums, known values and best rows per position, as one struct ``depth``."""
    keys = [*by, "pos"]
    listed = members.where(F.col("pos").isin(slots.positions))
    best = top_n(listed, keys, [(pred, False), (key, True)], max(slots.quotas.values()) + beyond)
    tops = best.groupBy(*keys).agg(F.sort_array(F.collect_list(_member(pred, error, key))).alias("top"))
    sums = listed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _zero(F.sum(amount(pred))).alias("p"),
        _zero(F.sum(amount(error))).alias("e"),
        F.count(pred).alias("cp"),
        F.count(error).alias("ce"),
    )
    return sums.join(tops, keys).select(*keys, F.struct("n", "p", "e", "cp", "ce", "top").alias("depth"))


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0)).cast("decimal(38,8)")


def _total_of(members: Column, part: str) -> Column:
    kind = "long" if part in ("cp", "ce") else "decimal(38,8)"
    start = F.lit(0).cast(kind)
    return F.coalesce(F.aggregate(members, start, lambda total, x: (total + x[part]).cast(kind)), start)


def _beyond(depth: Column, quota: int) -> dict[str, Column]:
    """Size, sums and known values of a position's members beyond its starters."""
    started = F.slice(depth["top"], 1, quota)
    rest = {c: F.coalesce(depth[c], F.lit(0)) - _total_of(started, c) for c in ("p", "e", "cp", "ce")}
    return {"n": F.coalesce(depth["n"], F.lit(0)) - quota, **rest}


def _row(pos: str, first: Column, second: Column, rest: dict[str, Column]) -> Column:
    def mean(total: str, known: str, default: float) -> Column:
        return F.when(rest[known] > 0, rest[total].cast("double") / rest[known]).otherwise(F.lit(default))

    return F.struct(
        F.lit(pos).alias("pos"),
        F.coalesce(first["pred"], F.lit(NO_POINTS)).alias("a_pred_points"),
        F.coalesce(first["error"], F.lit(NO_MEMBER_ERROR)).alias("a_std_error"),
        F.coalesce(second["pred"], F.lit(NO_POINTS)).alias("b_pred_points"),
        F.coalesce(second["error"], F.lit(NO_MEMBER_ERROR)).alias("b_std_error"),
        rest["n"].cast("bigint").alias("num_others"),
        mean("p", "cp", NO_POINTS).alias("avg_pred_points_other"),
        mean("e", "ce", NO_MEMBER_ERROR).alias("avg_std_error_other"),
    )


def _position_row(pos: str, depth: Column, quota: int) -> Column:
    started = F.slice(depth["top"], 1, quota)  # a second member counts only where two start
    return _row(pos, F.get(started, F.lit(0)), F.get(started, F.lit(1)), _beyond(depth, quota))


def _flex_row(slots: Slots) -> Column:
    groups = {p: F.col(f"_{p}") for p in slots.flex}
    spare = [F.slice(F.coalesce(g["top"], F.array()), slots.quotas[p] + 1, FLEX_STARTERS) for p, g in groups.items()]
    started = F.slice(F.sort_array(F.flatten(F.array(*spare))), 1, FLEX_STARTERS)
    left = [_beyond(g, slots.quotas[p]) for p, g in groups.items()]
    rest = {c: reduce(lambda a, b: a + b, [x[c] for x in left]) - _total_of(started, c) for c in ("p", "e", "cp", "ce")}
    rest["n"] = reduce(lambda a, b: a + b, [F.greatest(x["n"], F.lit(0)) for x in left]) - FLEX_STARTERS
    return _row(FLEX, F.get(started, F.lit(0)), F.get(started, F.lit(1)), rest)


def regression_set(outcome: DataFrame, members: DataFrame, features: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Outcomes joined onto features; every feature row stays."""
    return outcome.join(features(members), keys, "right")


def usable_profiles(profiles: DataFrame, league: str = "league") -> DataFrame:
    """Profiles without the leagues in which some group lacks a starter."""
    return drop_bad_groups(profiles, [league], F.col("num_others") == -1)


def starter_points(profiles: DataFrame, by: list[str], score: str, second: tuple[str, ...] = ("RB", "WR")) -> DataFrame:
    """Predicted points of a team's starters: the best of every position and the
    second best where two start; teams without such a position drop out."""
    two = F.col("pos").isin(list(second))
    sums = profiles.groupBy(*by).agg(
        _total(score).alias(score),
        (F.sum(amount("a_pred_points")) + F.sum(F.when(two, amount("b_pred_points")))).cast("double").alias("final_pred_points"),
    )
    return sums.where(F.col("final_pred_points").isNotNull())


def pivot_features(profiles: DataFrame, by: list[str], score: str, slots: Slots) -> DataFrame:
    """One row per team: the measures of every position and the team's total."""
    single = [p for p, q in slots.quotas.items() if q == 1]
    unused = tuple(f"{m}_{p}" for m in ("b_pred_points", "b_std_error") for p in single)
    return pivot_values(profiles, by, "pos", MEASURES, slots.positions, unused, {score: _total(score)})


def _total(score: str) -> Column:
    return F.coalesce(F.sum(amount(score)), F.lit(0)).cast("double")


def position_stats(profiles: DataFrame) -> DataFrame:
    """Points, players, average, variance and error of each position group."""
    n = F.col("num_others")
    b_error = F.when(F.col("b_std_error") == NO_MEMBER_ERROR, 0.0).otherwise(F.col("b_std_error"))
    variance = n * F.col("avg_std_error_other") * F.col("avg_std_error_other")
    variance = variance + F.col("a_std_error") * F.col("a_std_error") + b_error * b_error
    out = profiles.withColumns(
        {
            "total_points": n * F.col("avg_pred_points_other") + F.col("a_pred_points") + F.col("b_pred_points"),
            "total_players": n + 1 + F.when(F.col("b_pred_points") > 0, 1).otherwise(0),
            "position_variance": variance,
        }
    )
    return out.withColumns(
        {
            "average_points": F.try_divide(F.col("total_points"), F.col("total_players").cast("double")),
            "std_error": F.when(F.col("position_variance") >= 0, F.sqrt("position_variance")),
        }
    )


STATS = ["average_points", "total_players", "std_error"]


def pivot_stats(profiles: DataFrame, by: list[str], score: str, positions: list[str]) -> DataFrame:
    """One row per team: the statistics of every position and the team's total."""
    stats = position_stats(profiles)
    return pivot_values(stats, by, "pos", STATS, positions, extra={score: _total(score)})


def score_teams(profiles: DataFrame, predict: Callable[[DataFrame], DataFrame], by: list[str]) -> DataFrame:
    """Predicted total per team; ``predict`` adds a column ``prediction`` per position row."""
    return predict(profiles).groupBy(*by).agg(F.sum(amount("prediction")).cast("double").alias("total"))


def score_picks(picks: DataFrame, profiles: DataFrame, predict: Callable[[DataFrame], DataFrame], by: list[str]) -> DataFrame:
    """Attach the predicted total of its team to every pick that has a team."""
    teams = score_teams(profiles, predict, by)
    return join_to_groups(picks.where(F.col("team").isNotNull()), teams, by, "inner")
