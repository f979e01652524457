"""The domain tables, derived from the given ones: in Spark and as SQL views.

Positions of ``picks`` and ``drafted`` are part types, of ``season`` market segments,
of ``weekly`` event types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.functions import pick_owner
from seasonlab.operators import add_total, number_groups
from seasonlab.plans.lineup import Slots
from seasonlab.plans.season import collapse_duplicates
from seasonlab.session import derived_table

PICK_SLOTS = Slots({"ECONOMY": 1, "LARGE": 2, "MEDIUM": 2, "PROMO": 1}, ("LARGE", "MEDIUM", "PROMO"))
WEEK_SLOTS = Slots(
    {"view": 2, "click": 2, "signup": 1, "error": 1, "purchase": 1}, ("view", "click", "purchase")
)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LEADER = "BUILDING"
PREDICT = 2001
BASE_YEAR = 1994
TEMPERATURE = 40.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def picks(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as a pick of a two-team snake, numbered within its order."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("league"),
        F.col("l_partkey").alias("player_id"),
        money("l_extendedprice").alias("price"),
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        "l_shipdate",
        "l_quantity",
    )
    order = ["l_linenumber", "player_id", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]
    numbered = number_groups(lines, ["league"], [(c, True) for c in order], "pick")
    numbered = numbered.withColumn("pick", F.col("pick").cast("int"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("player_id"), F.col("p_type").alias("pos"))
    rows = numbered.select("league", "pick", pick_owner("pick", 2).alias("team"), "player_id", "price")
    return rows.join(part, "player_id")


def picks_total(spark: SparkSession, sf: str) -> DataFrame:
    """``picks`` with their team's total price: a derived table, since every drill-down
    starts from it. Sorted by pick within files, so that a filter on picks skips most of them."""

    def build() -> DataFrame:
        rows = derived_table(spark, "picks", inputs, lambda: picks(spark, sf))
        owned = add_total(rows, ["league", "team"], "price")
        return owned.select("league", "team", "pick", "player_id", "pos", "total").sortWithinPartitions("pick", "league")

    inputs = [f"{sf}/lineitem.parquet", f"{sf}/part.parquet"]
    return derived_table(spark, "picks-total", inputs, build)


def player_info(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").where(F.col("p_partkey") % 10 != 7)
    return part.select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("player"),
        F.col("p_brand").alias("tm"),
        F.col("p_type").alias("pos"),
        money("p_retailprice").alias("pred"),
        F.col("p_size").cast("decimal(18,2)").alias("var_pred"),
    )


def season_team(spark: SparkSession, sf: str) -> DataFrame:
    """Entity-seasons per team. Orders are added up before they meet their customer."""
    sums = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season"), "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("games"), F.sum(money("o_totalprice")).alias("pts"))
    )
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"), "c_mktsegment", "c_nationkey")
    return sums.join(customer, "player_id").select(
        "player_id",
        "season",
        F.col("c_mktsegment").alias("pos"),
        F.concat(F.lit("T"), (F.col("c_nationkey") % 5).cast("string"), "o_orderstatus").alias("tm"),
        "games",
        "pts",
    )


def season(spark: SparkSession, sf: str) -> DataFrame:
    rows = collapse_duplicates(season_team(spark, sf), ["player_id", "season"], "tm", "pts")
    return rows.select("player_id", "season", "pos", "tm", "pts")


def season_aged(spark: SparkSession, sf: str) -> DataFrame:
    """``season`` with an age that fits one birth year per entity."""
    age = F.col("season") - 1960 - (F.col("player_id") % 20).cast("int")
    return season(spark, sf).withColumn("age", age)


def rank_list(spark: SparkSession, sf: str, priorities: tuple[str, ...]) -> DataFrame:
    listed = table(spark, sf, "orders").where(F.substring("o_orderpriority", 1, 1).isin(list(priorities)))
    mean = F.sum(money("o_totalprice")).cast("double") / F.count(F.lit(1)) / 1000
    return listed.groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season")).agg(mean.alias("adp"))


def rank_a(spark: SparkSession, sf: str) -> DataFrame:
    return rank_list(spark, sf, ("1", "2", "3"))


def rank_b(spark: SparkSession, sf: str) -> DataFrame:
    return rank_list(spark, sf, ("3", "4", "5"))


def roster(spark: SparkSession, sf: str) -> DataFrame:
    """Rosters, also of entity-seasons without an order. The seasons travel as one array."""
    years = table(spark, sf, "orders").agg(F.collect_set(F.year("o_orderdate"))).scalar()
    rows = table(spark, sf, "customer").withColumn("season", F.explode(years))
    rows = rows.where((F.col("c_custkey") + F.col("season")) % 3 == 0)
    tm = F.concat(F.lit("T"), (F.col("c_nationkey") % 5).cast("string"))
    pick = F.concat(tm, F.lit(" / 1st / "), (F.col("c_custkey") % 250).cast("string"), F.lit("th pick / "), F.col("season").cast("string"))
    return rows.select(
        F.col("c_custkey").alias("player_id"),
        "season",
        F.concat(tm, F.lit("R")).alias("tm"),
        F.col("c_mktsegment").alias("pos"),
        F.when(F.col("c_custkey") % 7 == 0, "Rook").otherwise((F.col("c_custkey") % 12).cast("string")).alias("yrs"),
        F.when(F.col("c_custkey") % 5 != 0, pick).alias("drafted"),
    )


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        (F.floor((F.dayofmonth("ts") - 1) / 7).cast("int") + 1).alias("week"),
        F.concat(F.lit("team_"), (F.col("user_id") % 10).cast("string")).alias("team"),
        F.col("user_id").alias("player_id"),
        F.col("event_type").alias("pos"),
        money("value").alias("pts"),
    )


def _ship_month() -> Column:
    return F.year("l_shipdate") * 100 + F.month("l_shipdate")


def _ship_team() -> Column:
    return F.concat(F.lit("team_"), (F.col("l_suppkey") % 10).cast("string"))


def drafted(spark: SparkSession, sf: str) -> DataFrame:
    """Who is on which team of a league (a ship month); made distinct before the join. A
    derived table, since a query reads it up to eight times."""

    def build() -> DataFrame:
        owned = (
            table(spark, sf, "lineitem")
            .select(_ship_month().alias("league"), _ship_team().alias("team"), F.col("l_partkey").alias("player_id"))
            .distinct()
        )
        part = table(spark, sf, "part").select(
            F.col("p_partkey").alias("player_id"),
            F.col("p_type").alias("pos"),
            F.col("p_retailprice").alias("pred"),
            F.col("p_size").cast("double").alias("var_pred"),
        )
        return owned.join(part, "player_id").select("league", "team", "player_id", "pos", "pred", "var_pred")

    return derived_table(spark, "drafted", [f"{sf}/{t}.parquet" for t in ("lineitem", "part")], build)


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome per league, team and position: shipped value, in thousands per week. A derived
    table, as ``drafted``."""

    def build() -> DataFrame:
        sums = (
            table(spark, sf, "lineitem")
            .groupBy(_ship_month().alias("league"), _ship_team().alias("team"), F.col("l_partkey").alias("player_id"))
            .agg(F.sum(money("l_extendedprice")).alias("v"))
        )
        part = table(spark, sf, "part").select(F.col("p_partkey").alias("player_id"), F.col("p_type").alias("pos"))
        joined = sums.join(part, "player_id").groupBy("league", "team", "pos")
        return joined.agg((F.sum("v").cast("double") / 18000).alias("pts"))

    return derived_table(spark, "outcomes", [f"{sf}/{t}.parquet" for t in ("lineitem", "part")], build)


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "picks": (
        """SELECT league, pick,
  concat('team_', CAST(CASE WHEN CAST(floor((pick+1)/2.0) AS INT) % 2 = 1
         THEN (pick-1)%2+1 ELSE 2-(pick-1)%2 END AS VARCHAR)) AS team,
  player_id, p_type AS pos, price
FROM (SELECT l_orderkey AS league, l_partkey AS player_id,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
             CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
               l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS INT) AS pick
      FROM lineitem) l JOIN part ON player_id = p_partkey""",
        (),
    ),
    "picks_total": (
        "SELECT league, team, pick, player_id, pos, sum(price) OVER (PARTITION BY league, team) AS total FROM picks",
        ("picks",),
    ),
    "player_info": (
        """SELECT p_partkey AS player_id, p_name AS player, p_brand AS tm, p_type AS pos,
  CAST(p_retailprice AS DECIMAL(18,2)) AS pred, CAST(p_size AS DECIMAL(18,2)) AS var_pred
FROM part WHERE p_partkey % 10 <> 7""",
        (),
    ),
    "season_team": (
        """SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season, c_mktsegment AS pos,
  concat('T', CAST(c_nationkey % 5 AS VARCHAR), o_orderstatus) AS tm,
  count(*) AS games, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS pts
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
        (),
    ),
    "season": (
        """SELECT player_id, season, pos, CASE WHEN n > 1 THEN concat(tm,'TM') ELSE tm END AS tm, pts
FROM (SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY pts DESC, tm) rn,
             count(*) OVER (PARTITION BY player_id, season) n FROM season_team) t
WHERE rn = 1""",
        ("season_team",),
    ),
    "season_aged": (
        "SELECT *, season - 1960 - CAST(player_id % 20 AS INT) AS age FROM season",
        ("season",),
    ),
    "past": ("SELECT * FROM season_aged WHERE season <> 2001", ("season_aged",)),
    "rank_a": (
        """SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS adp
FROM orders WHERE substr(o_orderpriority,1,1) IN ('1','2','3') GROUP BY 1, 2""",
        (),
    ),
    "rank_b": (
        """SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INT) AS season,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS adp
FROM orders WHERE substr(o_orderpriority,1,1) IN ('3','4','5') GROUP BY 1, 2""",
        (),
    ),
    "blend": (
        """SELECT player_id, season, (coalesce(a.adp, b.adp) + coalesce(b.adp, a.adp)) / 2 AS adp
FROM rank_a a FULL JOIN rank_b b USING (player_id, season)""",
        ("rank_a", "rank_b"),
    ),
    "ranking": (
        """SELECT player_id, season, adp, concat('T', CAST(c_nationkey % 5 AS VARCHAR), 'X') AS tm, c_mktsegment AS pos
FROM blend JOIN customer ON player_id = c_custkey""",
        ("blend",),
    ),
    "roster": (
        """SELECT c_custkey AS player_id, season, concat('T', CAST(c_nationkey % 5 AS VARCHAR), 'R') AS tm,
  c_mktsegment AS pos,
  CASE WHEN c_custkey % 7 = 0 THEN 'Rook' ELSE CAST(c_custkey % 12 AS VARCHAR) END AS yrs,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('T', CAST(c_nationkey % 5 AS VARCHAR),
    ' / 1st / ', CAST(c_custkey % 250 AS VARCHAR), 'th pick / ', CAST(season AS VARCHAR)) END AS drafted
FROM customer CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS season FROM orders) y
WHERE (c_custkey + season) % 3 = 0""",
        (),
    ),
    "attributes": (
        """SELECT DISTINCT player_id, season, tm, pos,
  CAST(CASE WHEN yrs = 'Rook' THEN '0' ELSE yrs END AS INT) AS yrs,
  CASE WHEN yrs = 'Rook' THEN 1 ELSE 0 END AS rookie,
  nullif(regexp_extract(string_split(drafted, '/')[3], '([0-9]+)', 1), '') AS draft_pick
FROM roster""",
        ("roster",),
    ),
    "weekly": (
        """SELECT event_id, CAST(floor((day(ts)-1)/7.0) AS INT)+1 AS week,
  concat('team_', CAST(user_id % 10 AS VARCHAR)) AS team, user_id AS player_id,
  event_type AS pos, CAST(value AS DECIMAL(18,2)) AS pts FROM events""",
        (),
    ),
    "ranked": (
        """SELECT *, CASE WHEN pos IN ('view', 'click') THEN 2 ELSE 1 END AS quota,
  row_number() OVER (PARTITION BY week, team, pos ORDER BY pts DESC, event_id) AS rn FROM weekly""",
        ("weekly",),
    ),
    "drafted": (
        """SELECT DISTINCT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS league,
  concat('team_', CAST(l_suppkey % 10 AS VARCHAR)) AS team, p_partkey AS player_id,
  p_type AS pos, p_retailprice AS pred, CAST(p_size AS DOUBLE) AS var_pred
FROM lineitem JOIN part ON l_partkey = p_partkey""",
        (),
    ),
    "outcomes": (
        """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS league,
  concat('team_', CAST(l_suppkey % 10 AS VARCHAR)) AS team, p_type AS pos,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 18000 AS pts
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
        (),
    ),
    # Prior period by a full self-join; the predicted year keeps rows with prior values only.
    "prior": (
        """SELECT coalesce(n.player_id, p.player_id) AS player_id, coalesce(n.season, p.season + 1) AS season,
  n.pos, n.tm, n.pts, p.tm AS prv_tm, p.pts AS prv_pts, p.age AS prv_age,
  n.player_id IS NOT NULL AS in_now, p.player_id IS NOT NULL AS in_prior
FROM past n FULL JOIN past p ON n.player_id = p.player_id AND n.season = p.season + 1""",
        ("past",),
    ),
    "features": (
        """SELECT r.player_id, season, pos, tm, pts, season - year_born AS age, prv_tm, prv_pts,
  season - 1 AS prv_season, CASE WHEN in_prior THEN 0 ELSE 1 END AS missing_last,
  CASE WHEN tm = prv_tm OR prv_tm IS NULL THEN 0 ELSE 1 END AS changed_team, year_born
FROM (SELECT * FROM prior WHERE season = 2001 OR in_now) r
LEFT JOIN (SELECT player_id, min(season - (prv_age + 1)) AS year_born FROM prior
           WHERE prv_age IS NOT NULL AND (season = 2001 OR in_now) GROUP BY 1) b ON r.player_id = b.player_id""",
        ("prior",),
    ),
    "enriched": (
        """SELECT DISTINCT player_id, season, coalesce(f.pos, a.pos) AS pos, coalesce(f.tm, a.tm) AS tm, pts, age,
  prv_tm, prv_pts, prv_season, missing_last,
  CASE WHEN coalesce(f.tm, a.tm) = prv_tm OR prv_tm IS NULL THEN 0 ELSE 1 END AS changed_team,
  year_born, yrs, rookie, draft_pick
FROM features f FULL JOIN attributes a USING (player_id, season)
WHERE coalesce(f.pos, a.pos) IS NOT NULL""",
        ("features", "attributes"),
    ),
    "old_leaders": (
        """SELECT tm, season, max(pts) AS old_leader FROM enriched
WHERE pos = 'BUILDING' AND tm IS NOT NULL AND right(tm, 2) <> 'TM' GROUP BY 1, 2""",
        ("enriched",),
    ),
    "new_leaders": (
        """SELECT tm, season, max(prv_pts) AS new_leader FROM enriched
WHERE pos = 'BUILDING' AND tm IS NOT NULL AND right(tm, 2) <> 'TM' GROUP BY 1, 2""",
        ("enriched",),
    ),
    "led": (
        """SELECT e.*, o.old_leader, n.new_leader, n.new_leader - o.old_leader AS leader_diff,
  CASE WHEN n.new_leader IS NULL AND (e.tm IS NULL OR right(e.tm, 2) <> 'TM') THEN 1 ELSE 0 END AS no_new_leader
FROM enriched e
LEFT JOIN old_leaders o ON e.prv_tm = o.tm AND e.prv_season = o.season
LEFT JOIN new_leaders n ON e.tm = n.tm AND e.season = n.season""",
        ("old_leaders", "new_leaders"),
    ),
    "merged": (
        """SELECT player_id, season, coalesce(e.pos, r.pos) AS pos, coalesce(e.tm, r.tm) AS tm, pts, age, prv_pts,
  yrs, rookie, adp, season - 1 AS prv_season,
  CASE WHEN e.player_id IS NOT NULL AND r.player_id IS NOT NULL THEN 'both'
       WHEN e.player_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS found_rank
FROM enriched e FULL JOIN ranking r USING (player_id, season)""",
        ("enriched", "ranking"),
    ),
    "staged": (
        """SELECT m.*, m.adp * m.adp AS adp_sq, m.found_rank <> 'left_only' AS drafted,
  g.group_total, g.group_size,
  CASE WHEN g.group_total = 0 THEN NULL ELSE CAST(m.prv_pts AS DOUBLE) / g.group_total END AS group_share,
  CASE WHEN m.pos = 'AUTOMOBILE' THEN 1 ELSE 0 END AS "AUTOMOBILE",
  CASE WHEN m.pos = 'BUILDING' THEN 1 ELSE 0 END AS "BUILDING",
  CASE WHEN m.pos = 'FURNITURE' THEN 1 ELSE 0 END AS "FURNITURE",
  CASE WHEN m.pos = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "HOUSEHOLD",
  CASE WHEN m.pos = 'MACHINERY' THEN 1 ELSE 0 END AS "MACHINERY"
FROM merged m LEFT JOIN (
  SELECT tm, pos, season, coalesce(CAST(sum(prv_pts) AS DOUBLE), 0e0) AS group_total, count(*) AS group_size
  FROM merged WHERE tm IS NOT NULL AND pos IS NOT NULL AND right(tm, 2) <> 'TM' GROUP BY 1, 2, 3) g
ON m.tm = g.tm AND m.pos = g.pos AND m.season = g.season""",
        ("merged",),
    ),
    "ranked_members": (
        """SELECT league, team, pos, player_id, pred, var_pred,
  CAST(pred AS DECIMAL(18,2)) AS p, CAST(var_pred AS DECIMAL(18,2)) AS e,
  row_number() OVER (PARTITION BY league, team, pos ORDER BY pred DESC, player_id) AS rn,
  CASE WHEN pos IN ('LARGE','MEDIUM') THEN 2 ELSE 1 END AS quota
FROM drafted WHERE pos IN ('ECONOMY','LARGE','MEDIUM','PROMO')""",
        ("drafted",),
    ),
    "slot_members": (
        """SELECT league, team, pos AS slot, pred, var_pred, p, e, rn, quota FROM ranked_members
UNION ALL
SELECT league, team, 'FLEX', pred, var_pred, p, e,
  row_number() OVER (PARTITION BY league, team ORDER BY pred DESC, player_id), 2
FROM ranked_members WHERE pos <> 'ECONOMY' AND rn > quota""",
        ("ranked_members",),
    ),
    "profiles": (
        """SELECT g.league, g.team, g.pos,
  coalesce(max(CASE WHEN rn = 1 THEN pred END), 0e0) AS a_pred_points,
  coalesce(max(CASE WHEN rn = 1 THEN var_pred END), 1e4) AS a_std_error,
  coalesce(max(CASE WHEN rn = 2 AND g.q = 2 THEN pred END), 0e0) AS b_pred_points,
  coalesce(max(CASE WHEN rn = 2 AND g.q = 2 THEN var_pred END), 1e4) AS b_std_error,
  count(rn) - max(g.q) AS num_others,
  CASE WHEN count(rn) > max(g.q) THEN CAST(sum(CASE WHEN rn > g.q THEN p END) AS DOUBLE) / (count(rn) - max(g.q)) ELSE 0e0 END AS avg_pred_points_other,
  CASE WHEN count(rn) > max(g.q) THEN CAST(sum(CASE WHEN rn > g.q THEN e END) AS DOUBLE) / (count(rn) - max(g.q)) ELSE 1e4 END AS avg_std_error_other
FROM (SELECT t.league, t.team, s.pos, s.q
      FROM (SELECT DISTINCT league, team FROM ranked_members) t
      CROSS JOIN (VALUES ('ECONOMY', 1), ('LARGE', 2), ('MEDIUM', 2), ('PROMO', 1), ('FLEX', 2)) s(pos, q)) g
LEFT JOIN slot_members m ON g.league = m.league AND g.team = m.team AND g.pos = m.slot
GROUP BY 1, 2, 3""",
        ("slot_members",),
    ),
    "profile_set": (
        "SELECT p.*, o.pts FROM profiles p LEFT JOIN outcomes o USING (league, team, pos)",
        ("profiles", "outcomes"),
    ),
    "usable_set": (
        "SELECT * FROM profile_set WHERE league NOT IN (SELECT league FROM profiles WHERE num_others = -1)",
        ("profile_set",),
    ),
    "known_set": (
        """SELECT *, bucket % 100 < 80 AS is_train, bucket % 500 // 100 AS fold FROM (
  SELECT league, team, pos, CASE WHEN pos = 'FLEX' THEN spare ELSE pts END AS y,
    [a_pred_points, a_std_error, CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN b_pred_points ELSE 0e0 END,
     CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN b_std_error ELSE 0e0 END, CAST(num_others AS DOUBLE), avg_pred_points_other, avg_std_error_other] AS x,
    CAST(concat('0x', substr(md5(concat('_', CAST(league AS VARCHAR), '_', team)), 1, 8)) AS BIGINT) AS bucket
  FROM usable_set LEFT JOIN (SELECT league, team, CAST(sum(CAST(pts AS DECIMAL(24,8))) AS DOUBLE) AS spare FROM outcomes WHERE pos NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') GROUP BY 1, 2) USING (league, team)
) WHERE y IS NOT NULL""",
        ("usable_set", "outcomes"),
    ),
    # every position's lasso, its penalty by cross-validation, solved by coordinate descent
    "models": (
        """WITH RECURSIVE scales AS (SELECT pos, list(CASE WHEN top > 0 THEN top ELSE 1e0 END ORDER BY j) AS scale FROM (
  SELECT pos, j, max(abs(x[j])) AS top FROM known_set, range(1, 8) t(j) WHERE is_train GROUP BY 1, 2) GROUP BY 1),
rows AS (SELECT known_set.*, [1e0, y] || [x[j] / scale[j] for j in range(1, 8)] AS v FROM known_set JOIN scales USING (pos)),
cells AS (SELECT pos, fold, i, j, sum(v[i] * v[j]) AS s FROM rows, range(1, 10) a(i), range(1, 10) b(j) WHERE is_train GROUP BY ALL),
folds AS (SELECT DISTINCT pos, fold FROM cells UNION ALL SELECT DISTINCT pos, -1 FROM cells),
parts AS (SELECT f.pos, f.fold, i, j, sum(s) AS s FROM folds f JOIN cells c ON f.pos = c.pos AND f.fold <> c.fold GROUP BY ALL),
centred AS (SELECT p.pos, p.fold, p.i, p.j, p.s / n.s - a.s * b.s / (n.s * n.s) AS c FROM parts p
  JOIN parts n ON n.pos = p.pos AND n.fold = p.fold AND n.i = 1 AND n.j = 1
  JOIN parts a ON a.pos = p.pos AND a.fold = p.fold AND a.i = 1 AND a.j = p.i
  JOIN parts b ON b.pos = p.pos AND b.fold = p.fold AND b.i = 1 AND b.j = p.j WHERE p.i > 1 AND p.j > 1),
lines AS (SELECT pos, fold, i, list(c ORDER BY j) AS c FROM centred WHERE j > 2 GROUP BY ALL),
means AS (SELECT pos, fold, list(m ORDER BY j) AS m FROM (
  SELECT p.pos, p.fold, p.j, p.s / n.s AS m FROM parts p JOIN parts n ON n.pos = p.pos AND n.fold = p.fold AND n.i = 1 AND n.j = 1 WHERE p.i = 1) GROUP BY ALL),
systems AS (SELECT pos, fold, list(c ORDER BY i) FILTER (i > 2) AS c, any_value(c) FILTER (i = 2) AS by_y FROM lines GROUP BY ALL),
tops AS (SELECT pos, list_max([CASE WHEN c[j][j] > 1e-12 THEN abs(by_y[j]) ELSE 0e0 END for j in range(1, 8)]) AS top FROM systems WHERE fold = -1),
steps(pos, fold, k, step, w) AS (
  SELECT s.pos, s.fold, k, 0, [0e0 for j in range(1, 8)] FROM systems s, range(0, 100) g(k)
  UNION ALL
  SELECT t.pos, t.fold, k, step + 1, list_concat(list_concat(w[1 : j - 1], [CASE WHEN c[j][j] > 1e-12
    THEN sign(r) * greatest(abs(r) - top * pow(1e1, -3e0 * k / 99), 0e0) / c[j][j] ELSE 0e0 END]), w[j + 1 : 7])
  FROM (SELECT steps.*, s.c, tops.top, step % 7 + 1 AS j, s.by_y[step % 7 + 1] - list_dot_product(s.c[step % 7 + 1], w) + s.c[step % 7 + 1][step % 7 + 1] * w[step % 7 + 1] AS r
        FROM steps JOIN systems s USING (pos, fold) JOIN tops USING (pos) WHERE step < 560) t),
fitted AS (SELECT pos, fold, k, w, m[2] - list_dot_product(m[3 : 9], w) AS intercept FROM steps JOIN means USING (pos, fold) WHERE step = 560),
held AS (SELECT pos, fold, list(s ORDER BY i) AS s FROM (SELECT pos, fold, i, list(s ORDER BY j) AS s FROM cells GROUP BY ALL) GROUP BY ALL),
errors AS (SELECT pos, k, sum(list_sum([u[i] * list_dot_product(s[i], u) for i in range(1, 10)]) / s[1][1]) AS error
  FROM (SELECT f.pos, k, s, list_concat([-intercept, 1e0], [-a for a in w]) AS u FROM fitted f JOIN held h ON h.pos = f.pos AND h.fold = f.fold) GROUP BY ALL),
chosen AS (SELECT pos, min(k) AS k FROM (SELECT *, min(error) OVER (PARTITION BY pos) AS least FROM errors) WHERE error <= least * (1 + 1e-7) GROUP BY 1)
SELECT pos, n, top, top * pow(1e1, -3e0 * k / 99) AS penalty, intercept, w, scale FROM chosen JOIN fitted USING (pos, k) JOIN tops USING (pos) JOIN scales USING (pos)
JOIN (SELECT pos, count(*) AS n FROM known_set WHERE is_train GROUP BY 1) USING (pos) WHERE fold = -1""",
        ("known_set",),
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        _needed(VIEWS[name][1], seen)
        if name not in seen:
            seen.append(name)
    return seen


def with_views(sql: str, *names: str) -> str:
    """SQL text with the named views, and those they need, before it."""
    if not names:
        return sql
    parts = [f"{n} AS ({VIEWS[n][0]})" for n in _needed(names, [])]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
