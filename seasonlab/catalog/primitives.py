"""Filters, projections, joins, aggregates and scalar functions over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.registry import query
from seasonlab.catalog.views import table
from seasonlab.functions import (
    clean_name,
    ends_with_tm,
    first_digits,
    one_hot,
    parse_number,
    round_of_pick,
    season_of,
    snake_pick,
    snake_team,
    split_element,
    to_timestamp,
)
from seasonlab.functions.scoring import linear_score
from seasonlab.operators import (
    conditional_override,
    conditional_swap,
    count_violations,
    drop_non_numeric,
    except_keys,
    fd_violations,
    fill_from,
    group_sum,
    full_join,
    join_indicator,
    key_violations,
    map_values,
    null_counts,
    prior_period,
    short_span_keys,
    union_missing,
)
from seasonlab.plans.schedule import schedule, standings, wrong_sizes


@query(
    """SELECT l_orderkey AS order_key, l_partkey AS part_key, l_extendedprice AS price
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'"""
)
def scan_project(spark: SparkSession, sf: str) -> DataFrame:
    ship = F.col("l_shipdate")
    year = (ship >= F.lit("1998-01-01").cast("timestamp_ntz")) & (ship < F.lit("1999-01-01").cast("timestamp_ntz"))
    rows = table(spark, sf, "lineitem").where(year).select("l_orderkey", "l_partkey", "l_extendedprice")
    return rows.withColumnsRenamed({"l_orderkey": "order_key", "l_partkey": "part_key", "l_extendedprice": "price"})


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('F')"""
)
def filter_in(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    kept = lines.where(F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("F"))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT p_partkey, TRY_CAST(txt AS DOUBLE) AS number FROM (
  SELECT p_partkey, substr(p_brand, 7) AS txt FROM part UNION ALL SELECT p_partkey, p_name FROM part)
WHERE TRY_CAST(txt AS DOUBLE) IS NOT NULL""",
    name="drop_non_numeric",
)
def drop_non_numeric_rows(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    brands = part.select("p_partkey", F.substring("p_brand", 7, 100).alias("number"))
    names = part.select("p_partkey", F.col("p_name").alias("number"))
    return drop_non_numeric(brands.unionByName(names), "number")


@query(
    """SELECT player_id, season, pos, CASE WHEN yrs = 'Rook' AND pos2 = 'RB' THEN 'new'
  WHEN tm = 'T0R' AND season <= 1997 THEN 'OLD' ELSE tm END AS tm, pos2 AS role FROM (
  SELECT *, CASE WHEN pos = 'MACHINERY' THEN 'RB' WHEN contains(tm, '3') THEN 'WR' ELSE pos END AS pos2 FROM roster)""",
    "roster",
    name="conditional_override",
)
def conditional_override_chain(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        (F.col("tm").contains("3"), "role", "WR"),
        (F.col("pos") == "MACHINERY", "role", "RB"),
        ((F.col("tm") == "T0R") & (F.col("season") <= 1997), "tm", "OLD"),
        ((F.col("yrs") == "Rook") & (F.col("role") == "RB"), "tm", "new"),
    ]
    rows = views.roster(spark, sf).withColumn("role", F.col("pos"))
    return conditional_override(rows, rules).select("player_id", "season", "pos", "tm", "role")


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'QB' WHEN 'MACHINERY' THEN 'RB' ELSE c_mktsegment END AS segment,
  coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey""",
    name="map_values",
)
def map_values_both(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "nation").where("n_regionkey <> 1")
    names = names.select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation")
    )
    return map_values(map_values(rows, "segment", {"BUILDING": "QB", "MACHINERY": "RB"}), "nation", names)


@query(
    """SELECT player_id, season, coalesce(drafted, 'undrafted') AS drafted, coalesce(nullif(yrs, 'Rook'), tm) AS yrs FROM roster""",
    "roster",
)
def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.roster(spark, sf).withColumn("yrs", F.nullif(F.col("yrs"), F.lit("Rook")))
    filled = fill_from(rows, {"drafted": "undrafted", "yrs": F.col("tm")})
    return filled.select("player_id", "season", "drafted", "yrs")


@query(
    """SELECT player_id, season,
  CASE WHEN pos = 'AUTOMOBILE' THEN 1 ELSE 0 END AS "AUTOMOBILE", CASE WHEN pos = 'BUILDING' THEN 1 ELSE 0 END AS "BUILDING",
  CASE WHEN pos = 'FURNITURE' THEN 1 ELSE 0 END AS "FURNITURE", CASE WHEN pos = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "HOUSEHOLD",
  CASE WHEN pos = 'MACHINERY' THEN 1 ELSE 0 END AS "MACHINERY" FROM season""",
    "season",
    name="one_hot",
)
def one_hot_positions(spark: SparkSession, sf: str) -> DataFrame:
    return views.season(spark, sf).select("player_id", "season", *one_hot("pos", views.SEGMENTS))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE o_custkey END AS home,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_orderkey END AS away FROM orders""",
    name="conditional_swap",
)
def conditional_swap_pair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").withColumn("at", F.when(F.col("o_orderstatus") == "F", "@"))
    return conditional_swap(rows, "at", "o_custkey", "o_orderkey", ("home", "away")).select("o_orderkey", "home", "away")


# ---- joins


@query(
    """SELECT event_id, player_id, pos, c_name AS name FROM weekly JOIN customer ON player_id = c_custkey""",
    "weekly",
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("name"))
    return views.weekly(spark, sf).join(names, "player_id").select("event_id", "player_id", "pos", "name")


@query(
    """SELECT league, pick, p.player_id, p.pos, i.player, CAST(i.pred AS DOUBLE) AS pred
FROM picks p LEFT JOIN player_info i ON p.player_id = i.player_id AND p.pos = i.pos""",
    "picks",
    "player_info",
)
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    info = views.player_info(spark, sf).select("player_id", "pos", "player", F.col("pred").cast("double").alias("pred"))
    joined = views.picks_total(spark, sf).join(info, ["player_id", "pos"], "left")
    return joined.select("league", "pick", "player_id", "pos", "player", "pred")


@query(
    """SELECT player_id, season, CAST(pts AS DOUBLE) AS pts, r.tm, yrs FROM (SELECT player_id, season, pts FROM season) s RIGHT JOIN roster r USING (player_id, season)""",
    "season",
    "roster",
)
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    seasons = views.season(spark, sf).select("player_id", "season", F.col("pts").cast("double").alias("pts"))
    joined = seasons.join(views.roster(spark, sf), ["player_id", "season"], "right")
    return joined.select("player_id", "season", "pts", "tm", "yrs")


@query(
    "SELECT player_id, season, a.adp AS adp_a, b.adp AS adp_b FROM rank_a a FULL JOIN rank_b b USING (player_id, season)",
    "rank_a",
    "rank_b",
)
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    a = views.rank_a(spark, sf).withColumnRenamed("adp", "adp_a")
    return a.join(views.rank_b(spark, sf).withColumnRenamed("adp", "adp_b"), ["player_id", "season"], "full")


@query(
    """SELECT player_id, season, s.tm, r.yrs, CASE WHEN s.player_id IS NOT NULL AND r.player_id IS NOT NULL THEN 'both'
  WHEN s.player_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS found
FROM season s FULL JOIN roster r USING (player_id, season)""",
    "season",
    "roster",
    name="join_indicator",
)
def join_indicator_sides(spark: SparkSession, sf: str) -> DataFrame:
    seasons = views.season(spark, sf).select("player_id", "season", "tm")
    rosters = views.roster(spark, sf).select("player_id", "season", "yrs")
    return join_indicator(seasons, rosters, ["player_id", "season"])


@query(
    """WITH a AS (SELECT CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN event_id END AS k, event_id, value FROM events),
b AS (SELECT CASE WHEN event_id % 7 = 0 THEN event_id WHEN event_id = 6 THEN 0 WHEN event_id % 5 = 0 THEN -event_id END AS k, user_id FROM events
  WHERE event_id % 7 = 0 OR event_id = 6 OR event_id % 5 = 0 OR event_id = 8)
SELECT coalesce(a.k, b.k) AS k, event_id, value, user_id, CASE WHEN b.user_id IS NULL THEN 'left_only' WHEN a.event_id IS NULL THEN 'right_only' ELSE 'both' END AS found
FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k"""
)
def join_full_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows has one key and a third has none; null keys meet each other."""
    i = F.col("event_id")
    events = table(spark, sf, "events")
    left = events.select(F.when(i % 3 == 0, 0).when(i % 3 == 1, i).alias("k"), "event_id", "value")
    right = events.where((i % 7 == 0) | (i == 6) | (i % 5 == 0) | (i == 8))
    right = right.select(F.when(i % 7 == 0, i).when(i == 6, 0).when(i % 5 == 0, -i).alias("k"), "user_id")
    return full_join(left, right, ["k"], "found")


@query(
    """SELECT coalesce(n.player_id, p.player_id) AS player_id, coalesce(n.season, p.season + 1) AS season,
  n.pos, n.tm, CAST(n.pts AS DOUBLE) AS pts, p.tm AS prv_tm, CAST(p.pts AS DOUBLE) AS prv_pts,
  CASE WHEN n.player_id IS NOT NULL AND p.player_id IS NOT NULL THEN 'both'
       WHEN n.player_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS found_prior
FROM season n FULL JOIN season p ON n.player_id = p.player_id AND n.season = p.season + 1""",
    "season",
    name="prior_period",
)
def prior_period_join(spark: SparkSession, sf: str) -> DataFrame:
    seasons = views.season(spark, sf).withColumn("pts", F.col("pts").cast("double"))
    return prior_period(seasons, "player_id", "season", {"tm": "prv_tm", "pts": "prv_pts"})


@query(
    """SELECT league, pick, player_id, team FROM picks WHERE league IN (SELECT league FROM picks WHERE pick = 1 AND pos = 'PROMO')""",
    "picks",
)
def join_semi(spark: SparkSession, sf: str) -> DataFrame:
    picks = views.picks_total(spark, sf)
    opened = picks.where("pick = 1 and pos = 'PROMO'").select("league")
    return picks.join(opened, "league", "left_semi").select("league", "pick", "player_id", "team")


@query(
    """SELECT DISTINCT player_id, season FROM rank_a EXCEPT SELECT DISTINCT player_id, season FROM rank_b""",
    "rank_a",
    "rank_b",
    name="except_keys",
)
def except_keys_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return except_keys(views.rank_a(spark, sf), views.rank_b(spark, sf), ["player_id", "season"])


# ---- aggregates


@query(
    """SELECT tm, season, CAST(sum(pts) AS DOUBLE) AS pts, count(*) AS players FROM season GROUP BY 1, 2""",
    "season",
)
def agg_sum(spark: SparkSession, sf: str) -> DataFrame:
    return group_sum(views.season(spark, sf), ["tm", "season"], {"pts": "pts"}, count="players")


@query(
    """SELECT pos, season, CAST(min(pts) AS DOUBLE) AS low, CAST(max(pts) AS DOUBLE) AS high FROM season GROUP BY 1, 2""",
    "season",
)
def agg_min_max(spark: SparkSession, sf: str) -> DataFrame:
    grouped = views.season(spark, sf).groupBy("pos", "season")
    return grouped.agg(F.min("pts").cast("double").alias("low"), F.max("pts").cast("double").alias("high"))


@query("SELECT DISTINCT tm, season, pos FROM season_team", "season_team")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return views.season_team(spark, sf).select("tm", "season", "pos").distinct()


@query(
    "SELECT pos, count(*) AS n, count(DISTINCT tm) AS teams FROM season GROUP BY 1",
    "season",
)
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return views.season(spark, sf).groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("tm").alias("teams"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20 OFFSET 5"""
)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*columns, "l_extendedprice")
    return lines.orderBy(F.col("l_extendedprice").desc(), *columns).offset(5).limit(20)


@query(
    """SELECT event_id AS id, user_id AS key, 'event' AS kind FROM events
UNION ALL SELECT o_orderkey, o_custkey, 'order' FROM orders UNION ALL SELECT c_custkey, c_custkey, 'customer' FROM customer"""
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    def part(name: str, id_: str, key: str, kind: str) -> DataFrame:
        return table(spark, sf, name).select(F.col(id_).alias("id"), F.col(key).alias("key"), F.lit(kind).alias("kind"))

    orders = part("orders", "o_orderkey", "o_custkey", "order")
    customers = part("customer", "c_custkey", "c_custkey", "customer")
    return part("events", "event_id", "user_id", "event").unionByName(orders).unionByName(customers)


@query(
    """SELECT player_id, season, CAST(pts AS DOUBLE) AS pts, NULL AS yrs FROM season
UNION ALL SELECT player_id, season, NULL, yrs FROM roster UNION ALL SELECT player_id, season, NULL, yrs FROM roster""",
    "season",
    "roster",
    name="union_missing",
)
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    seasons = views.season(spark, sf).select("player_id", "season", F.col("pts").cast("double").alias("pts"))
    rosters = views.roster(spark, sf).select("player_id", "season", "yrs")
    return union_missing(seasons, rosters, rosters)


# ---- scalar functions


@query(
    """SELECT p_partkey, trim(replace(name, 'red ', 'r.e.d. ')) AS name FROM (
  SELECT p_partkey, trim(regexp_replace(trim(regexp_replace(regexp_replace(raw, '[*+]', '', 'g'), '\\(.*?\\)', '', 'g')), '\\s+I+$', '')) AS name
  FROM (SELECT p_partkey, concat(p_name, CASE p_size % 4 WHEN 0 THEN ' III' WHEN 1 THEN '*+' WHEN 2 THEN ' (R) II' ELSE ' (x)(y)+ ' END) AS raw FROM part))"""
)
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_size") % 4
    ending = F.when(kind == 0, " III").when(kind == 1, "*+").when(kind == 2, " (R) II").otherwise(" (x)(y)+ ")
    raw = table(spark, sf, "part").select("p_partkey", F.concat("p_name", ending).alias("raw"))
    return raw.select("p_partkey", F.trim(F.replace(clean_name("raw"), F.lit("red "), F.lit("r.e.d. "))).alias("name"))


@query(
    """SELECT p_partkey, nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS brand, nullif(regexp_extract(p_name, '([0-9]+)', 1), '') AS none FROM part"""
)
def extract_digits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", first_digits("p_brand").alias("brand"), first_digits("p_name").alias("none")
    )


@query(
    """SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS level, string_split(o_orderpriority, '-')[2] AS label,
  string_split(o_orderpriority, '-')[3] AS missing FROM orders"""
)
def split_part(spark: SparkSession, sf: str) -> DataFrame:
    names = ["level", "label", "missing"]
    parts = [split_element("o_orderpriority", "-", i).alias(n) for i, n in enumerate(names)]
    return table(spark, sf, "orders").select("o_orderkey", *parts)


@query(
    """SELECT c_custkey, lower(c_name) AS low, trim(concat('  ', c_mktsegment, ' ')) AS trimmed, starts_with(c_name, 'Customer#00000000') AS starts,
  contains(c_mktsegment, 'HO') AS has, right(c_name, 2) AS tail, concat('_', CAST(c_nationkey AS VARCHAR), '_', c_mktsegment) AS id,
  right(c_mktsegment, 2) = 'TM' AS multi FROM customer"""
)
def string_funcs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.lower("c_name").alias("low"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.col("c_name").startswith("Customer#00000000").alias("starts"),
        F.col("c_mktsegment").contains("HO").alias("has"),
        F.right("c_name", F.lit(2)).alias("tail"),
        F.concat(F.lit("_"), F.col("c_nationkey").cast("string"), F.lit("_"), "c_mktsegment").alias("id"),
        ends_with_tm("c_mktsegment").alias("multi"),
    )


@query("SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS at FROM events")
def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "h:mma").alias("clock")
    )
    return texts.select("event_id", to_timestamp("day", "clock").alias("at"))


@query(
    """SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INT) AS season FROM orders"""
)
def season_of_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", season_of("o_orderdate").alias("season"))


@query(
    """SELECT league, pick, CAST(floor((pick + 1) / 2.0) AS INT) AS round, CAST(right(team, 1) AS INT) AS owner, pick AS again FROM picks""",
    "picks",
    name="snake_pick",
)
def snake_pick_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.picks_total(spark, sf).select("league", "pick")
    rows = rows.withColumns({"round": round_of_pick("pick", 2), "owner": snake_team("pick", 2)})
    return rows.withColumn("again", snake_pick("owner", "round", 2))


@query(
    """SELECT l_orderkey, l_linenumber, score, score - l_quantity > 0.1e0 AS off FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, coalesce(l_quantity, 0e0) * 4e-2 + coalesce(l_extendedprice, 0e0) * 1e-1 + coalesce(l_discount, 0e0) * -2e0 + coalesce(l_tax, 0e0) * 6e0 AS score FROM lineitem)"""
)
def weighted_score(spark: SparkSession, sf: str) -> DataFrame:
    weights = {"l_quantity": 0.04, "l_extendedprice": 0.1, "l_discount": -2, "l_tax": 6}
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", linear_score(weights).alias("score"))
    return rows.select("l_orderkey", "l_linenumber", "score", (F.col("score") - F.col("l_quantity") > 0.1).alias("off"))


@query("SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INT) AS brand, TRY_CAST(p_name AS INT) AS none FROM part")
def number_from_text(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    brand = parse_number(F.substring("p_brand", 7, 100), strict=True, kind="int").alias("brand")
    return part.select("p_partkey", brand, parse_number("p_name", kind="int").alias("none"))


# ---- checks


@query(
    """SELECT tm, min(season) AS first, max(season) AS last FROM season WHERE tm NOT IN ('T0FTM', 'T1FTM') GROUP BY 1 HAVING max(season) - min(season) < 7""",
    "season",
    name="short_span_keys",
)
def short_span_teams(spark: SparkSession, sf: str) -> DataFrame:
    return short_span_keys(views.season(spark, sf), "tm", "season", 7, ["T0FTM", "T1FTM"])


@query(
    "SELECT player_id, min(tm) AS low, max(tm) AS high FROM season GROUP BY 1 HAVING count(DISTINCT tm) > 1",
    "season",
    name="fd_violations",
)
def fd_violations_team(spark: SparkSession, sf: str) -> DataFrame:
    return fd_violations(views.season(spark, sf), "player_id", "tm")


@query(
    "SELECT player_id, season, count(*) AS n FROM season_team GROUP BY 1, 2 HAVING count(*) <> 1",
    "season_team",
    name="count_violations",
)
def count_violations_season(spark: SparkSession, sf: str) -> DataFrame:
    return count_violations(views.season_team(spark, sf), ["player_id", "season"], 1)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    name="key_violations",
)
def key_violations_lines(spark: SparkSession, sf: str) -> DataFrame:
    return key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT CAST(count_if(drafted IS NULL) AS BIGINT) AS drafted, CAST(count_if(yrs IS NULL) AS BIGINT) AS yrs,
  CAST(count_if(tm IS NULL) AS BIGINT) AS tm FROM roster""",
    "roster",
    name="null_counts",
)
def null_counts_roster(spark: SparkSession, sf: str) -> DataFrame:
    counts = null_counts(views.roster(spark, sf), ["drafted", "yrs", "tm"])
    return counts


# ---- schedules and standings


@query(
    """SELECT CAST(month(o_orderdate) AS VARCHAR) AS "Week", CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_orderkey END AS home,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE o_custkey END AS away, o_orderdate + INTERVAL 20 HOUR + INTERVAL 15 MINUTE AS datetime
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')"""
)
def schedule_games(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    week = F.when(priority == "1-URGENT", "Week").when(priority == "5-LOW", "SuperBowl")
    games = table(spark, sf, "orders").select(
        week.otherwise(F.month("o_orderdate").cast("string")).alias("Week"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.lit("8:15PM").alias("Time"),
        F.col("o_orderkey").alias("winner"),
        F.col("o_custkey").alias("loser"),
        F.when(F.col("o_orderstatus") == "F", "@").alias("at"),
    )
    return schedule(games)


def _conference(spark: SparkSession, sf: str, name: str, even: int) -> DataFrame:
    """One half of the customers as a standings page, with group headers and marks."""
    rows = table(spark, sf, "customer").where(F.col("c_nationkey") % 2 == even)
    return rows.select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(f"{name} East")).otherwise(F.concat("c_mktsegment", F.lit("*+ 1"))).alias("Tm"),
        F.col("c_nationkey").alias("W"),
        (F.col("c_nationkey") + 1).alias("L"),
        F.lit(0).alias("T"),
        F.col("c_custkey").alias("PF"),
        F.col("c_acctbal").alias("PA"),
    )


@query(
    """SELECT c_mktsegment AS "Tm", c_nationkey AS "W", c_nationkey + 1 AS "L", 0 AS "T", c_custkey AS "PF", c_acctbal AS "PA"
FROM customer WHERE c_mktsegment <> 'BUILDING'"""
)
def standings_union(spark: SparkSession, sf: str) -> DataFrame:
    return standings(_conference(spark, sf, "AFC", 0), _conference(spark, sf, "NFC", 1))


@query(
    """SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'AFC' ELSE 'NFC' END AS conference, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) <> 16"""
)
def standings_sizes(spark: SparkSession, sf: str) -> DataFrame:
    tables = [_conference(spark, sf, c, i).withColumn("conference", F.lit(c)) for i, c in enumerate(["AFC", "NFC"])]
    return wrong_sizes(tables[0].unionByName(tables[1]))
