"""Roster profiles and the feature tables made of them."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.registry import query
from seasonlab.functions import amount
from seasonlab.operators import r2
from seasonlab.plans import profile as plan
from seasonlab.plans import sampling

BY = ["league", "team"]
POSITIONS = views.PICK_SLOTS.positions


def profile_set(spark: SparkSession, sf: str) -> DataFrame:
    make = partial(plan.group_profile, slots=views.PICK_SLOTS)
    return plan.regression_set(views.outcomes(spark, sf), views.drafted(spark, sf), make, [*BY, "pos"])


def usable_set(spark: SparkSession, sf: str) -> DataFrame:
    """Without the leagues in which some team lacks a starter."""
    return plan.usable_profiles(profile_set(spark, sf))


def a_plus_b(profiles: DataFrame) -> DataFrame:
    """A fixed prediction: the points of the first and second best member."""
    return profiles.withColumn("prediction", F.col("a_pred_points") + F.col("b_pred_points"))


MEASURES_SQL = "a_pred_points, a_std_error, b_pred_points, b_std_error, num_others, avg_pred_points_other, avg_std_error_other"
STATS_SQL = """SELECT *, total_points / nullif(CAST(total_players AS DOUBLE), 0e0) AS average_points, CASE WHEN position_variance >= 0 THEN sqrt(position_variance) END AS std_error FROM (
  SELECT *, num_others * avg_pred_points_other + a_pred_points + b_pred_points AS total_points,
    num_others + 1 + CASE WHEN b_pred_points > 0 THEN 1 ELSE 0 END AS total_players,
    num_others * avg_std_error_other * avg_std_error_other + a_std_error * a_std_error
      + CASE WHEN b_std_error = 1e4 THEN 0e0 ELSE b_std_error END * CASE WHEN b_std_error = 1e4 THEN 0e0 ELSE b_std_error END AS position_variance
  FROM usable_set)"""


def _wide(measures: list[str], skip: tuple[str, ...] = ()) -> str:
    cells = [
        f"max(CASE WHEN pos = '{p}' THEN {m} END) AS \"{m}_{p}\""
        for m in measures
        for p in POSITIONS
        if f"{m}_{p}" not in skip
    ]
    return ", ".join(cells)


TOTAL_SQL = "coalesce(CAST(sum(CAST(pts AS DECIMAL(24,8))) AS DOUBLE), 0e0) AS pts"


@query(f"SELECT league, team, pos, {MEASURES_SQL} FROM profiles", "profiles")
def group_profile(spark: SparkSession, sf: str) -> DataFrame:
    return plan.group_profile(views.drafted(spark, sf), views.PICK_SLOTS)


@query(f"SELECT league, team, pos, pts, {MEASURES_SQL} FROM profile_set", "profile_set")
def regression_set(spark: SparkSession, sf: str) -> DataFrame:
    return profile_set(spark, sf).select(*BY, "pos", "pts", *plan.MEASURES)


@query(
    """SELECT league, team, pos, num_others FROM profiles WHERE league NOT IN (SELECT league FROM profiles WHERE num_others = -1)""",
    "profiles",
)
def drop_bad_groups(spark: SparkSession, sf: str) -> DataFrame:
    profiles = plan.group_profile(views.drafted(spark, sf), views.PICK_SLOTS)
    return plan.usable_profiles(profiles).select(*BY, "pos", "num_others")


@query(
    """SELECT league, team, round(pts, 6) AS pts, final_pred_points FROM (SELECT league, team, coalesce(CAST(sum(CAST(pts AS DECIMAL(24,8))) AS DOUBLE), 0e0) AS pts,
  CAST(sum(CAST(a_pred_points AS DECIMAL(18,2))) + sum(CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN CAST(b_pred_points AS DECIMAL(18,2)) END) AS DOUBLE) AS final_pred_points
FROM usable_set GROUP BY 1, 2)""",
    "usable_set",
)
def starter_points(spark: SparkSession, sf: str) -> DataFrame:
    out = plan.starter_points(usable_set(spark, sf), BY, "pts", ("LARGE", "MEDIUM"))
    return out.withColumn("pts", F.round("pts", 6))


_UNUSED = tuple(f"{m}_{p}" for m in ("b_pred_points", "b_std_error") for p in ("ECONOMY", "PROMO"))


@query(
    f"""SELECT w.*, round(t.pts, 6) AS pts FROM (SELECT league, team, {_wide(plan.MEASURES, _UNUSED)} FROM usable_set WHERE pos <> 'FLEX' GROUP BY 1, 2) w
JOIN (SELECT league, team, {TOTAL_SQL} FROM usable_set GROUP BY 1, 2) t USING (league, team)""",
    "usable_set",
)
def pivot_features(spark: SparkSession, sf: str) -> DataFrame:
    out = plan.pivot_features(usable_set(spark, sf), BY, "pts", views.PICK_SLOTS)
    return out.withColumn("pts", F.round("pts", 6))


@query(
    f"SELECT league, team, pos, total_points, total_players, average_points, position_variance, std_error FROM ({STATS_SQL})",
    "usable_set",
)
def position_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = plan.position_stats(usable_set(spark, sf))
    return stats.select(*BY, "pos", "total_points", "total_players", "average_points", "position_variance", "std_error")


@query(
    f"""SELECT w.*, round(t.pts, 6) AS pts FROM (SELECT league, team, {_wide(plan.STATS)} FROM ({STATS_SQL}) WHERE pos <> 'FLEX' GROUP BY 1, 2) w
JOIN (SELECT league, team, {TOTAL_SQL} FROM usable_set GROUP BY 1, 2) t USING (league, team)""",
    "usable_set",
)
def pivot_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = plan.pivot_stats(usable_set(spark, sf), BY, "pts", POSITIONS)
    return out.withColumn("pts", F.round("pts", 6))


@query(
    """SELECT league, team, pos, CASE WHEN CAST(concat('0x', substr(md5(concat('_', CAST(league AS VARCHAR), '_', team)), 1, 8)) AS BIGINT) % 100 < 80
  THEN 'train' ELSE 'test' END AS part FROM profiles""",
    "profiles",
)
def split_by_group(spark: SparkSession, sf: str) -> DataFrame:
    profiles = plan.group_profile(views.drafted(spark, sf), views.PICK_SLOTS)
    return sampling.split_by_group(profiles, BY).select(*BY, "pos", "part")


@query(
    """SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS r2 FROM (
  SELECT league, team, CAST(sum(CAST(pts AS DECIMAL(24,8))) AS DOUBLE) AS y, CAST(sum(CAST(a_pred_points AS DECIMAL(18,2)) + CAST(b_pred_points AS DECIMAL(18,2))) AS DOUBLE) AS p
  FROM profile_set GROUP BY 1, 2) WHERE y IS NOT NULL""",
    "profile_set",
)
def r2_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Fit of predictions added up per team."""
    scored = a_plus_b(profile_set(spark, sf))
    teams = scored.groupBy(*BY).agg(
        F.sum(amount("pts")).cast("double").alias("y"), F.sum(amount("prediction")).cast("double").alias("p")
    )
    return r2(teams, "y", "p").select(F.round("r2", 4).alias("r2"))


@query(
    """SELECT d.league, d.team, d.player_id, d.pos, t.total FROM drafted d JOIN (
  SELECT league, team, CAST(sum(CAST(a_pred_points AS DECIMAL(18,2)) + CAST(b_pred_points AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM profiles GROUP BY 1, 2) t USING (league, team)""",
    "profiles",
    "drafted",
)
def score_picks(spark: SparkSession, sf: str) -> DataFrame:
    members = views.drafted(spark, sf)
    profiles = plan.group_profile(members, views.PICK_SLOTS)
    scored = plan.score_picks(members, profiles, a_plus_b, BY)
    return scored.select(*BY, "player_id", "pos", "total")


def with_depth(profiles: DataFrame) -> DataFrame:
    """A fixed prediction in which the rest of the group counts for a tenth."""
    starters = F.col("a_pred_points") + F.col("b_pred_points")
    return profiles.withColumn("prediction", starters + 0.1 * F.col("avg_pred_points_other"))


@query(
    """WITH mine AS (SELECT league, player_id, pos, CAST(pred AS DECIMAL(18,2)) AS p FROM drafted WHERE team = 'team_1'),
cand AS (SELECT league, team, player_id, pos, CAST(pred AS DECIMAL(18,2)) AS p, row_number() OVER () AS c
  FROM drafted WHERE team <> 'team_1' AND pos IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')),
both_lists AS (SELECT c, cand.pos, mine.player_id, mine.p, 0 AS own FROM cand JOIN mine USING (league, pos)
  UNION ALL SELECT c, pos, player_id, p, 1 FROM cand),
placed AS (SELECT *, CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN 2 ELSE 1 END AS q,
  row_number() OVER (PARTITION BY c ORDER BY p DESC, player_id) AS after_rn,
  row_number() OVER (PARTITION BY c ORDER BY own, p DESC, player_id) AS before_rn FROM both_lists),
sums AS (SELECT c,
  coalesce(CAST(max(CASE WHEN after_rn = 1 THEN p END) AS DOUBLE), 0e0) + coalesce(CAST(max(CASE WHEN after_rn = 2 AND q = 2 THEN p END) AS DOUBLE), 0e0)
    + 1e-1 * coalesce(CAST(sum(CASE WHEN after_rn > q THEN p END) AS DOUBLE) / count(CASE WHEN after_rn > q THEN 1 END), 0e0) AS after_pred,
  coalesce(CAST(max(CASE WHEN own = 0 AND before_rn = 1 THEN p END) AS DOUBLE), 0e0) + coalesce(CAST(max(CASE WHEN own = 0 AND before_rn = 2 AND q = 2 THEN p END) AS DOUBLE), 0e0)
    + 1e-1 * coalesce(CAST(sum(CASE WHEN own = 0 AND before_rn > q THEN p END) AS DOUBLE) / count(CASE WHEN own = 0 AND before_rn > q THEN 1 END), 0e0) AS before_pred
  FROM placed GROUP BY 1)
SELECT league, team, player_id, pos, after_pred - before_pred AS value_add FROM cand JOIN sums USING (c)""",
    "drafted",
)
def value_added(spark: SparkSession, sf: str) -> DataFrame:
    """What any other team's member would add to team_1 of the same league."""
    members = views.drafted(spark, sf)
    mine, others = members.where("team = 'team_1'"), members.where("team <> 'team_1'")
    out = plan.value_added(others, mine, views.PICK_SLOTS, with_depth)
    return out.select(*BY, "player_id", "pos", "value_add")
