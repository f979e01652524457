"""Path drill-downs over recorded picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.registry import query
from seasonlab.functions import Choice, make_choice
from seasonlab.plans import drill_index, paths
from seasonlab.session import derived_table

TEAMS = 2
OPENING = (Choice(1, positions=("PROMO",)),)
IDS = (make_choice(["AvgPROMO", "AvgLARGE"], 1, list(views.PICK_SLOTS.quotas)), Choice(2, positions=("MEDIUM", "SMALL")))
KNOWN = "i.player IS NOT NULL AND i.tm IS NOT NULL AND i.pred IS NOT NULL AND i.var_pred IS NOT NULL"

NEXT_SQL = f"""sub AS (SELECT p.* FROM picks_total p WHERE team = 'team_1' AND pick = 4
  AND league IN (SELECT league FROM picks_total WHERE pick = 1 AND pos = 'PROMO')),
known AS (SELECT s.player_id, s.pos, i.player, i.tm, i.pred, i.var_pred, s.total
  FROM sub s LEFT JOIN player_info i ON s.player_id = i.player_id AND s.pos = i.pos),
per_player AS (SELECT CAST(player_id AS VARCHAR) AS player_id, pos, player, tm, CAST(pred AS DOUBLE) AS pred,
  CAST(var_pred AS DOUBLE) AS var_pred, count(total) AS count, CAST(sum(total) AS DOUBLE) / count(total) AS mean
  FROM known i WHERE {KNOWN} GROUP BY 1, 2, 3, 4, 5, 6),
per_pos AS (SELECT pos, count(total) AS count, CAST(sum(total) AS DOUBLE) / count(total) AS mean,
  CAST(sum(pred) AS DOUBLE) / count(pred) AS pred, CAST(sum(var_pred) AS DOUBLE) / count(var_pred) AS var_pred
  FROM known WHERE pos IS NOT NULL GROUP BY 1)"""


@query(
    f"""WITH {NEXT_SQL}
SELECT player_id, pos, player, tm, pred, var_pred, count, mean,
  CAST(count AS DOUBLE) / (SELECT sum(count) FROM per_player) * 100 AS pct FROM per_player
UNION ALL
SELECT concat('Avg', pos), pos, concat(pos, ' - Average'), NULL, pred, var_pred, count, mean,
  CAST(count AS DOUBLE) / (SELECT sum(count) FROM per_pos) * 100 FROM per_pos""",
    "picks_total",
    "player_info",
)
def path_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Leagues opened with PROMO: what team_1 chose in round 2 and how it ended."""
    picks, info = views.picks_total(spark, sf), views.player_info(spark, sf)
    return paths.path_summary(picks, info, 1, 2, OPENING, TEAMS)


@query(
    f"""WITH {NEXT_SQL}
SELECT 4 AS pick, CAST((SELECT sum(total) FROM known i WHERE {KNOWN}) + (SELECT sum(total) FROM known) AS DOUBLE)
  / CAST((SELECT count(total) FROM known i WHERE {KNOWN}) + (SELECT count(total) FROM known) AS DOUBLE) AS expected,
  (SELECT count(total) FROM known) AS samples""",
    "picks_total",
    "player_info",
)
def expected_outcome(spark: SparkSession, sf: str) -> DataFrame:
    picks, info = views.picks_total(spark, sf), views.player_info(spark, sf)
    return paths.expected_outcome(picks, info, 1, 2, OPENING, TEAMS)


@query(
    """SELECT league FROM picks GROUP BY 1 HAVING bool_or(pick = 1 AND pos = 'PROMO') AND bool_or(pick = 2 AND pos = 'LARGE')""",
    "picks",
)
def path_leagues(spark: SparkSession, sf: str) -> DataFrame:
    path = [*OPENING, Choice(2, positions=("LARGE",))]
    return paths.path_leagues(views.picks_total(spark, sf), path)


@query(
    """SELECT league FROM picks GROUP BY 1
HAVING bool_or(pick = 1 AND (pos IN ('PROMO', 'LARGE'))) AND bool_or(pick = 2 AND (player_id IN (3, 5, 8, 13, 21) OR pos = 'SMALL'))""",
    "picks",
)
def path_leagues_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Conditions given as entered ids, mixed with whole positions."""
    named = make_choice([3, 5, 8, 8, 13, 21, "AvgSMALL"], 2, ["SMALL", "MEDIUM"])
    return paths.path_leagues(views.picks_total(spark, sf), [IDS[0], named])


@query(
    """SELECT p.pos, count(total) AS count, CAST(sum(total) AS DOUBLE) / count(total) AS mean,
  CAST(sum(pred) AS DOUBLE) / count(pred) AS pred, CAST(sum(var_pred) AS DOUBLE) / count(var_pred) AS var_pred,
  CAST(count(total) AS DOUBLE) / (SELECT count(total) FROM picks_total) * 100 AS pct
FROM picks_total p LEFT JOIN player_info i ON p.player_id = i.player_id AND p.pos = i.pos GROUP BY 1""",
    "picks_total",
    "player_info",
)
def position_averages(spark: SparkSession, sf: str) -> DataFrame:
    tally = paths.tally_choices(views.picks_total(spark, sf), views.player_info(spark, sf))
    return paths.position_averages(tally, ["pred", "var_pred"])


@query(
    """SELECT pos, CAST(to_json({'player_id': p_partkey, 'pos': p_type, 'size': p_size}) AS VARCHAR) AS record
FROM (SELECT *, p_type AS pos FROM part)"""
)
def records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as JSON records, the form a summary is handed out in."""
    part = views.table(spark, sf, "part")
    rows = part.select(F.col("p_partkey").alias("player_id"), F.col("p_type").alias("pos"), F.col("p_size").alias("size"))
    return rows.select("pos", F.to_json(F.struct("player_id", "pos", "size")).alias("record"))


@query(
    """SELECT league FROM picks_total GROUP BY 1
HAVING bool_or(pick = 1 AND (pos = 'PROMO' OR total > 150000)) AND bool_or(pick = 2 AND player_id % 2 = 0)""",
    "picks_total",
)
def path_text_predicate(spark: SparkSession, sf: str) -> DataFrame:
    """Leagues on a path whose conditions also hold predicates given as text."""
    conditions = [Choice(1, positions=("PROMO",), where="total > 150000"), Choice(2, where="player_id % 2 = 0")]
    return paths.path_leagues(views.picks_total(spark, sf), conditions)


def indexed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The numbers of the leagues and the index of choices, written once."""
    inputs = [f"{sf}/lineitem.parquet", f"{sf}/part.parquet"]
    numbers = derived_table(spark, "league-numbers", inputs, lambda: drill_index.number_leagues(views.picks_total(spark, sf)))

    def build() -> DataFrame:
        index = drill_index.build_index(views.picks_total(spark, sf), numbers)
        return index.repartitionByRange("pick", "kind", "value").sortWithinPartitions("pick", "kind", "value")

    return numbers, derived_table(spark, "choice-index", inputs, build)


@query(
    """SELECT league FROM picks GROUP BY 1 HAVING bool_or(pick = 1 AND pos IN ('PROMO', 'LARGE'))
  AND bool_or(pick = 2 AND (pos = 'SMALL' OR player_id % 2 = 0 AND player_id <= 60)) AND bool_or(pick = 3 AND pos <> 'ECONOMY')""",
    "picks",
)
def path_leagues_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Three conditions answered from the index, the third as a question about the answer to two."""
    numbers, index = indexed(spark, sf)
    opened = [Choice(1, positions=("PROMO", "LARGE")), Choice(2, ids=tuple(range(0, 61, 2)), positions=("SMALL",))]
    third = Choice(3, positions=("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))
    answer = drill_index.follow(index, [third], drill_index.follow(index, opened))
    return drill_index.leagues_of(answer, numbers)


@query(
    """SELECT pos, count(*) AS leagues FROM (SELECT DISTINCT league, pos FROM picks WHERE pick = 2 AND league IN (SELECT league FROM picks WHERE pick = 1 AND pos = 'PROMO')) GROUP BY 1""",
    "picks",
)
def path_counts_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """How many leagues opened with PROMO went on with each position: counts of bits alone."""
    _, index = indexed(spark, sf)
    opened = drill_index.follow(index, [Choice(1, positions=("PROMO",))])
    second = index.where("pick = 2 AND kind = 'pos'").select("value", "bucket", "few", "bits")
    listed = second.select("value", "bucket", F.explode("few").alias("place")).groupBy("value", "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    each = listed.unionByName(second.where("bits IS NOT NULL").select("value", "bucket", "bits"))
    both = each.unionByName(each.select("value", "bucket").distinct().join(opened, "bucket").select("value", "bucket", "bits"))
    met = both.groupBy("value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n")).where("n = 2")
    return met.groupBy(F.col("value").alias("pos")).agg(F.sum(F.bitmap_count("bits")).alias("leagues")).where("leagues > 0")
