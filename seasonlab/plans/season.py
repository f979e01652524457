"""From season rows to a feature table, one row per entity and season."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.functions import ends_with_tm, first_digits, flag, one_hot, split_element
from seasonlab.functions.scalars import MULTI_TEAM_SUFFIX
from seasonlab.operators import best_per_key, full_join, group_sum, join_indicator, join_to_groups, map_values, top_n

Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, steps: Sequence[tuple[str, Step]]) -> DataFrame:
    """Apply named preparation steps in order."""
    return reduce(lambda out, step: out.transform(step[1]), steps, df)


def collapse_duplicates(df: DataFrame, keys: list[str], team: str, score: str) -> DataFrame:
    """One row per entity and season, the best scoring one; the team of an entity
    listed under several is marked with a suffix."""
    best = best_per_key(df, keys, [(score, False), (team, True)], count="_n")
    marked = F.when(F.col("_n") > 1, F.concat(team, F.lit(MULTI_TEAM_SUFFIX))).otherwise(F.col(team))
    return best.withColumn(team, marked).select(*df.columns)


def prior_period_features(df: DataFrame, predict: int, key: str = "player_id", period: str = "season", team: str = "tm", score: str = "pts", age: str | None = "age") -> DataFrame:
    """Values of the period before, with flags for a missing one and a changed team.

    Rows must be unique per (key, period). Entities seen in the period before the
    predicted one also get a row for the predicted period, holding prior values only.
    All windows share one partitioning, so the table is shuffled once.
    """
    by_period = Window.partitionBy(key).orderBy(period)
    before = by_period.rangeBetween(-1, -1)
    after = by_period.rangeBetween(1, 1)
    carried = [team, score] + ([age] if age else [])
    now = F.struct(*carried)
    rows = df.withColumn("_prior", F.first(now).over(before)).withColumn("_next", F.count(F.lit(1)).over(after))

    rest = [c for c in df.columns if c not in (key, period)]
    own = F.struct(F.col(period).alias("_p"), *rest, F.col("_prior"))
    empty = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in rest]
    ahead = F.struct((F.col(period) + 1).alias("_p"), *empty, now.alias("_prior"))
    add = (F.col(period) == predict - 1) & (F.col("_next") == 0)
    out = rows.select(key, F.explode(F.when(add, F.array(own, ahead)).otherwise(F.array(own))).alias("_row"))
    out = out.select(key, F.col("_row._p").cast("int").alias(period), *[F.col(f"_row.{c}").alias(c) for c in rest], "_row._prior")

    out = out.withColumns(
        {
            f"prv_{team}": F.col(f"_prior.{team}"),
            f"prv_{score}": F.col(f"_prior.{score}"),
            f"prv_{period}": F.col(period) - 1,
            "missing_last": flag(F.col("_prior").isNull()),
        }
    )
    out = changed_team(out, team, f"prv_{team}")
    if age:
        born = F.col(period) - (F.col(f"_prior.{age}") + 1)
        out = out.withColumn("year_born", F.min(born).over(Window.partitionBy(key)))
        out = out.withColumn(age, F.col(period) - F.col("year_born"))
    return out.drop("_prior")


def changed_team(df: DataFrame, team: str = "tm", prior: str = "prv_tm") -> DataFrame:
    """0 when the team is the prior one or there is no prior one, else 1 (also for a null team)."""
    same = (F.col(team) == F.col(prior)) | F.col(prior).isNull()
    return df.withColumn("changed_team", F.when(same, 0).otherwise(1))


def enrich_full_outer(df: DataFrame, roster: DataFrame, keys: list[str], shared: list[str], required: str, team: str = "tm", prior: str = "prv_tm") -> DataFrame:
    """Add a roster: shared columns are filled from it, its other columns are added,
    and entities only the roster knows become new rows."""
    renamed = roster.withColumnsRenamed({c: f"_{c}" for c in shared})
    joined = full_join(df, renamed, keys)
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in shared})
    filled = filled.drop(*[f"_{c}" for c in shared])
    return changed_team(filled, team, prior).where(F.col(required).isNotNull()).distinct()


def prior_group_max(df: DataFrame, role, team: str, period: str, value: str, name: str) -> DataFrame:
    """Best value among rows of a role per team and period, multi-team rows left out."""
    known = F.col(team).isNotNull() & F.col(period).isNotNull()
    chosen = df.where(role & known & ~ends_with_tm(team))
    return chosen.groupBy(team, period).agg(F.max(value).alias(name))


def leader_change(df: DataFrame, role: str, pos: str = "pos", team: str = "tm", period: str = "season", score: str = "pts") -> DataFrame:
    """Compare the leader a team had with the one it has now.

    Old leader: best score of the role on the entity's prior team, prior period.
    New leader: best prior score of the role among this team's rows.
    """
    known = F.col(team).isNotNull() & F.col(period).isNotNull()
    chosen = df.where((F.col(pos) == role) & known & ~ends_with_tm(team))
    best = F.struct(F.max(score).alias("now"), F.max(f"prv_{score}").alias("before"))
    leaders = chosen.groupBy(team, period).agg(best.alias("_best"))  # one table, so one shuffle, for both lookups
    out = join_to_groups(df, leaders.withColumnsRenamed({team: f"prv_{team}", period: f"prv_{period}"}), [f"prv_{team}", f"prv_{period}"])
    out = out.withColumn("old_leader", F.col("_best.now")).drop("_best")
    out = join_to_groups(out, leaders, [team, period])
    out = out.withColumn("new_leader", F.col("_best.before")).drop("_best")
    missing = F.col("new_leader").isNull() & ~ends_with_tm(team)
    return out.withColumns({"leader_diff": F.col("new_leader") - F.col("old_leader"), "no_new_leader": flag(missing)})


def share_of_group(df: DataFrame, value: str = "prv_pts", team: str = "tm", pos: str = "pos", period: str = "season") -> DataFrame:
    """Total prior value and size of each team's position group, and the row's share of it."""
    keys = [team, pos, period]
    groups = group_sum(df.where(~ends_with_tm(team)), keys, {value: "group_total"}, count="group_size")
    out = join_to_groups(df.drop("group_total", "group_size", "group_share"), groups, keys)
    return out.withColumn("group_share", F.try_divide(F.col(value).cast("double"), F.col("group_total")))


def roster_attributes(roster: DataFrame, years: str = "yrs", drafted: str = "drafted", team: str = "tm", team_codes: dict | DataFrame | None = None) -> DataFrame:
    """Rookie flag, overall pick from ``tm / rnd / pick / yr`` and years played."""
    out = map_values(roster, team, team_codes) if team_codes else roster
    out = out.withColumns(
        {
            "rookie": flag(F.col(years) == "Rook"),
            "draft_pick": first_digits(split_element(drafted, "/", 2)),
            years: F.when(F.col(years) == "Rook", 0).otherwise(F.col(years).cast("int")),
        }
    )
    return out.drop(drafted).distinct()


def stage_merge(features: DataFrame, ranking: DataFrame, keys: list[str], rating: str, positions: list[str], team: str = "tm", pos: str = "pos", period: str = "season", value: str = "prv_pts") -> DataFrame:
    """Merge rankings (keys, rating, tm, pos) into the feature table.

    Entities known only from the rankings become rows, which changes the groups, so
    shares are worked out again.
    """
    other = [c for c in (team, pos) if c not in keys]
    renamed = ranking.select(*keys, rating, *[F.col(c).alias(f"_{c}") for c in other])
    out = join_indicator(features, renamed, keys, "found_rank")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in other}).drop(*[f"_{c}" for c in other])
    out = out.withColumn(f"prv_{period}", F.col(period) - 1)
    out = out.select("*", *one_hot(pos, positions))
    out = share_of_group(out, value, team, pos, period)
    return out.withColumns(
        {"drafted": F.col("found_rank") != "left_only", f"{rating}_sq": F.col(rating) * F.col(rating)}
    )


def add_final_fields(df: DataFrame, base_year: int, period: str = "season", age: str = "age", default_age: float = 23) -> DataFrame:
    """Year counted from a base and a default age."""
    return df.withColumns(
        {"adj_year": F.col(period) - base_year, age: F.coalesce(F.col(age), F.lit(default_age))}
    )


def final_limits(df: DataFrame, base_year: int, predict: int, period: str = "season", score: str = "pts", required: str = "rookie", found: str = "found_rank", age: str = "age") -> DataFrame:
    """Rows fit for training: in range, with an outcome, known from the season table."""
    out = add_final_fields(df, base_year, period, age)
    return out.where(
        (F.col("adj_year") > 0)
        & (F.col("adj_year") < predict - base_year)
        & (F.col(found) != "right_only")
        & (F.col(period) != predict)
        & F.col(score).isNotNull()
        & F.col(required).isNotNull()
    )


def player_pool(df: DataFrame, year: int, rating: str, key: str = "player_id", period: str = "season", pos: str = "pos", found: str = "found_rank", flex: tuple[str, ...] = ("RB", "TE", "WR")) -> DataFrame:
    """Entities that can be chosen in a year, once each, with empty team and pick."""
    pool = df.where((F.col(period) == year) & F.col(found).isin("left_only", "both"))
    ranked = pool.withColumn("_unrated", F.col(rating).isNull())
    ties = [(c, True) for c in df.columns if c not in (key, rating)]
    best = top_n(ranked, [key], [("_unrated", True), (rating, True), *ties], 1).drop("_unrated", "rn")
    return best.withColumns(
        {
            "flex": flag(F.col(pos).isin(list(flex))),
            "team": F.lit(None).cast("string"),
            "pick": F.lit(None).cast("double"),
        }
    )
