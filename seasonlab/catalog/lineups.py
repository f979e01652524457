"""Weekly scores and lineups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.registry import query
from seasonlab.operators import number_rows
from seasonlab.operators import nth_best as nth
from seasonlab.plans import lineup as plan
from seasonlab.plans import sampling

PLACES = {"ECONOMY": 5, "LARGE": 10, "MEDIUM": 10, "PROMO": 5}
PLACES_SQL = "CASE p_type WHEN 'ECONOMY' THEN 5 WHEN 'LARGE' THEN 10 WHEN 'MEDIUM' THEN 10 WHEN 'PROMO' THEN 5 END"
USER_PLACES = {"QB": 2, "RB": 4, "WR": 4, "TE": 2}


@query(
    """SELECT event_id, week, team, pos, CAST(row_number() OVER (PARTITION BY week, team, pos ORDER BY pts DESC, event_id) AS INT) AS rn FROM weekly""",
    "weekly",
)
def rank_in_group(spark: SparkSession, sf: str) -> DataFrame:
    order = [("pts", False), ("event_id", True)]
    ranked = number_rows(views.weekly(spark, sf), ["week", "team", "pos"], order)
    return ranked.select("event_id", "week", "team", "pos", F.col("rn").cast("int").alias("rn"))


@query(
    """SELECT team, slot AS pos, CAST(sum(pts) AS DOUBLE) / 18 AS pts FROM (
  SELECT week, team, pos AS slot, pts FROM ranked WHERE rn <= quota
  UNION ALL
  SELECT week, team, 'FLEX', pts FROM (SELECT *, row_number() OVER (PARTITION BY week, team ORDER BY pts DESC, event_id) AS fr
    FROM ranked WHERE rn > quota AND pos IN ('view', 'click', 'purchase')) WHERE fr = 1)
GROUP BY 1, 2""",
    "weekly",
    "ranked",
)
def best_lineup(spark: SparkSession, sf: str) -> DataFrame:
    return plan.best_lineup(views.weekly(spark, sf), views.WEEK_SLOTS, tie=("event_id",))


@query(
    f"""SELECT p_partkey AS player_id, p_type AS pos, p_retailprice AS points, CAST(rn AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = {PLACES_SQL}"""
)
def nth_best(spark: SparkSession, sf: str) -> DataFrame:
    best = nth(views.table(spark, sf, "part"), "p_type", [("p_retailprice", False), ("p_partkey", True)], PLACES)
    return best.select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_type").alias("pos"),
        F.col("p_retailprice").alias("points"),
        F.col("rn").alias("place"),
    )


@query(
    f"""SELECT CAST(week AS INT) AS week, team, pos, points / 18 AS pts, concat('baseline', pos) AS player
FROM (SELECT DISTINCT team FROM drafted) CROSS JOIN (SELECT unnest(generate_series(1, 18)) AS week) CROSS JOIN (
  SELECT p_type AS pos, p_retailprice AS points FROM (
    SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = {PLACES_SQL})""",
    "drafted",
)
def baseline_grid(spark: SparkSession, sf: str) -> DataFrame:
    teams = views.drafted(spark, sf).select("team").distinct()
    part = views.table(spark, sf, "part").withColumnRenamed("p_type", "pos")
    points = plan.replacement_points(part, "p_retailprice", "p_partkey", "pos", PLACES)
    return plan.baseline_grid(teams, points)


def _role(user: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in ("QB", "RB", "WR", "TE")]), (user % 4 + 1).cast("int"))


@query(
    """WITH users AS (SELECT user_id AS player_id, sum(CAST(value AS DECIMAL(18,2))) AS pts,
    CASE user_id % 4 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' ELSE 'TE' END AS pos FROM events GROUP BY 1, 3),
base AS (SELECT pos, CAST(pts AS DOUBLE) AS points FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY pts DESC, player_id) AS rn
    FROM users WHERE (player_id // 4) % 3 = 0) WHERE rn = CASE pos WHEN 'QB' THEN 2 WHEN 'RB' THEN 4 WHEN 'WR' THEN 4 ELSE 2 END),
spare AS (SELECT CAST(week AS INT) AS week, team, pos, concat('baseline', pos) AS player, points / 5 AS pts
    FROM (SELECT DISTINCT concat('team_', CAST(player_id % 10 AS VARCHAR)) AS team FROM users WHERE (player_id // 4) % 3 <> 0)
    CROSS JOIN (SELECT unnest(generate_series(1, 5)) AS week) CROSS JOIN base)
SELECT week, concat('team_', CAST(player_id % 10 AS VARCHAR)) AS team,
  CASE player_id % 4 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' ELSE 'TE' END AS pos, player_id, NULL AS player,
  coalesce(CAST(pts AS DOUBLE), 0e0) + 5e-1 * CAST(CASE WHEN pos = 'view' THEN week ELSE 0 END AS DOUBLE) AS pts
FROM weekly WHERE (player_id // 4) % 3 <> 0
UNION ALL SELECT week, team, pos, NULL, player, pts FROM spare
UNION ALL SELECT week, team, pos, NULL, player, pts FROM spare""",
    "weekly",
)
def weekly_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly texts of drafted users scored, with replacement rows from undrafted users."""
    events = views.weekly(spark, sf)
    users = events.groupBy("player_id").agg(F.sum("pts").alias("pts")).withColumn("pos", _role(F.col("player_id")))
    users = users.withColumn("free", F.floor(F.col("player_id") / 4) % 3 == 0)
    team = F.concat(F.lit("team_"), (F.col("player_id") % 10).cast("string"))
    chosen = users.where(~F.col("free")).select("player_id", team.alias("team"), "pos")
    points = plan.replacement_points(users.where("free"), "pts", "player_id", places=USER_PLACES)
    spare = plan.baseline_grid(chosen.select("team").distinct(), points, weeks=5)
    texts = events.select(
        "player_id",
        F.col("week").cast("string").alias("week"),
        F.col("pts").cast("string").alias("fant_pt"),
        F.when(F.col("pos") == "view", F.col("week").cast("string")).otherwise("none").alias("rec"),
    )
    return plan.weekly_scores(texts, chosen, spare, 0.5).select("week", "team", "pos", "player_id", "player", "pts")


@query(
    """WITH pool AS (SELECT league, team, player_id, pos, CAST(pred AS DECIMAL(18,2)) AS pred FROM drafted),
gone AS (SELECT *, row_number() OVER (PARTITION BY league ORDER BY pred DESC, player_id, team) AS rn FROM pool),
still AS (SELECT *, row_number() OVER (PARTITION BY league, pos ORDER BY pred DESC, player_id, team) AS pr FROM gone WHERE rn > 12),
bases AS (SELECT league, pos, CAST(sum(pred) AS DOUBLE) / count(pred) AS pred_base FROM still WHERE pr <= 3 GROUP BY 1, 2)
SELECT league, team, player_id, pos, pred_base, CAST(pred AS DOUBLE) - pred_base AS pred_diff FROM pool LEFT JOIN bases USING (league, pos)""",
    "drafted",
)
def replacement_level(spark: SparkSession, sf: str) -> DataFrame:
    order = [("pred", False), ("player_id", True), ("team", True)]
    pool = views.drafted(spark, sf).select("league", "team", "player_id", "pos", "pred")
    out = sampling.replacement_level(pool, ["league"], "pos", order, ["pred"], wait=12)
    return out.select("league", "team", "player_id", "pos", "pred_base", "pred_diff")
