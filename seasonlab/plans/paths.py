"""Drill-down over recorded paths: given these choices, what came next and how did it end?

``picks`` has one row per (league, pick) with columns league, team, pick, player_id,
pos, total. ``info`` has one row per (player_id, pos).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.functions import Choice, amount
from seasonlab.functions.choices import POSITION_PREFIX
from seasonlab.operators import share_percent, union_missing


def pick_number(team: int, round_: int, teams: int = 10) -> int:
    """Overall pick of a team in a round of a snake order."""
    if not 0 < team <= teams or round_ < 1:
        raise ValueError(f"no team {team} or round {round_} in a draft of {teams} teams")
    return (round_ - 1) * teams + team if round_ % 2 else round_ * teams - team + 1


def path_leagues(picks: DataFrame, conditions: Sequence[Choice]) -> DataFrame:
    """Leagues in which every condition is met by some pick.

    One aggregate for any number of conditions, over only the rows that meet one of
    them. Persist the result to drill further down the same path.
    """
    if not conditions:
        return picks.select("league").distinct()
    tests = [c.column() for c in conditions]
    rows = picks.where(reduce(lambda a, b: a | b, tests))
    met = rows.groupBy("league").agg(*[F.bool_or(t).alias(f"c{i}") for i, t in enumerate(tests)])
    every = reduce(lambda a, b: a & b, [F.col(f"c{i}") for i in range(len(tests))])
    return met.where(every).select("league")


def chosen_next(picks: DataFrame, team: int, round_: int, conditions: Sequence[Choice] = (), teams: int = 10) -> DataFrame:
    """The picks of a team in a round, in leagues that followed the path.

    Conditions and wanted picks are read in one pass: a league contributes no more
    rows than there are conditions, plus one, so only those are shuffled.
    """
    pick = pick_number(team, round_, teams)
    wanted = (F.col("team") == f"team_{team}") & (F.col("pick") == pick)
    if not conditions:
        return picks.where(wanted)
    tests = {f"_c{i}": c.column() for i, c in enumerate(conditions)}
    rows = picks.where(reduce(lambda a, b: a | b, tests.values(), wanted))
    league = Window.partitionBy("league")
    met = rows.withColumns({name: F.bool_or(test).over(league) for name, test in tests.items()})
    followed = reduce(lambda a, b: a & b, [F.col(name) for name in tests], wanted)
    return met.where(followed).select(*picks.columns)


def tally_choices(rows: DataFrame, info: DataFrame) -> DataFrame:
    """Rows, outcomes and exact outcome sum per choice, with what is known about it.

    Counted before the join, so a choice made in every league is one row there.
    """
    tally = rows.groupBy("player_id", "pos").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("total").alias("_n"), F.sum(amount("total")).alias("_sum")
    )
    return tally.join(info, ["player_id", "pos"], "left")


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def position_averages(tally: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Count, mean outcome and mean measures per position over all tallied picks."""
    times = F.col("_rows").cast("decimal(12,0)")
    aggs = [F.sum("_n").alias("count"), _mean(F.sum("_sum"), F.sum("_n")).alias("mean")]
    for m in measures:
        known = F.when(F.col(m).isNotNull(), F.col("_rows"))
        aggs.append(_mean(F.sum(amount(m) * times), F.sum(known)).alias(m))
    out = tally.where(F.col("pos").isNotNull()).groupBy("pos").agg(*aggs)
    return share_percent(out, "count")


def _described(info: DataFrame) -> list[str]:
    return [c for c in info.columns if c not in ("player_id", "pos")]


def _known(info: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ["player_id", "pos", *_described(info)]])


def summarise(tally: DataFrame, info: DataFrame, digits: int | None = None) -> DataFrame:
    """Rows per player and per position from a tally, best outcome first.

    Players with an unknown info column appear only in their position's row.
    """
    described = _described(info)
    measures = [c for c in described if dict(info.dtypes)[c] != "string"]
    players = tally.where(_known(info)).select(
        F.col("player_id").cast("string").alias("player_id"),
        "pos",
        *[F.col(c).cast("double").alias(c) if c in measures else F.col(c) for c in described],
        F.col("_n").alias("count"),
        _mean(F.col("_sum"), F.col("_n")).alias("mean"),
    )
    players = share_percent(players, "count")
    positions = position_averages(tally, measures).withColumns(
        {
            "player_id": F.concat(F.lit(POSITION_PREFIX), "pos"),
            "player": F.concat("pos", F.lit(" - Average")),
        }
    )
    out = union_missing(players, positions)
    if digits is not None:
        out = out.withColumns({c: F.bround(c, digits) for c in ("mean", "pct", *measures)})
    return out.orderBy(F.col("mean").desc(), F.col("player_id"))


def expect(tally: DataFrame, info: DataFrame, pick: int) -> DataFrame:
    """Expected outcome and number of samples behind it, as one row.

    The mean runs over player rows and position rows alike, weighted by their counts.
    """
    per_player = [F.when(_known(info), F.col(c)) for c in ("_sum", "_n")]
    per_pos = [F.when(F.col("pos").isNotNull(), F.col(c)) for c in ("_sum", "_n")]
    nothing = F.lit(0)
    total = F.coalesce(F.sum(per_player[0]), nothing) + F.coalesce(F.sum(per_pos[0]), nothing)
    n = F.coalesce(F.sum(per_player[1]), nothing) + F.coalesce(F.sum(per_pos[1]), nothing)
    return tally.agg(
        F.lit(pick).alias("pick"),
        _mean(total, n).alias("expected"),
        F.coalesce(F.sum(per_pos[1]), nothing).alias("samples"),
    )


def path_summary(picks: DataFrame, info: DataFrame, team: int, round_: int, conditions: Sequence[Choice] = (), teams: int = 10, digits: int | None = None) -> DataFrame:
    """What was chosen next on a path, per player and per position.

    Nothing is cached. The tally is read for rows, position rows and shares; where that
    is dear, persist :func:`tally_choices` yourself and give it to :func:`summarise`.
    """
    return summarise(tally_choices(chosen_next(picks, team, round_, conditions, teams), info), info, digits)


def expected_outcome(picks: DataFrame, info: DataFrame, team: int, round_: int, conditions: Sequence[Choice] = (), teams: int = 10) -> DataFrame:
    """Expected outcome of the path and the number of samples behind it, as one row."""
    tally = tally_choices(chosen_next(picks, team, round_, conditions, teams), info)
    return expect(tally, info, pick_number(team, round_, teams))


def before_choice(picks: DataFrame, info: DataFrame, team: int, round_: int, conditions: Sequence[Choice] = (), teams: int = 10, digits: int | None = None) -> tuple[int, DataFrame, DataFrame]:
    """All a team wants to know before a choice: its pick number, the summary and the
    expected outcome, both from one tally."""
    pick = pick_number(team, round_, teams)
    tally = tally_choices(chosen_next(picks, team, round_, conditions, teams), info)
    return pick, summarise(tally, info, digits), expect(tally, info, pick)


def to_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Rows as JSON records."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
