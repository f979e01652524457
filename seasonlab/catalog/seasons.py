"""Season tables: prior periods, rosters, leaders, shares, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.registry import query
from seasonlab.functions import Scoring, one_hot
from seasonlab.functions.scoring import score_season_stats
from seasonlab.operators import apply_rules, blend_means, join_indicator, join_to_groups, map_values, one_hot_violations
from seasonlab.plans import rankings as spelling
from seasonlab.plans import season as plan
from seasonlab.plans.sampling import sampled_order as draw_orders
from seasonlab.plans.sampling import softmax_group as softmax
from seasonlab.session import derived_table, new_path
from seasonlab.sources import overwrite_table, read_by_suffix


def features(spark: SparkSession, sf: str) -> DataFrame:
    past = views.season_aged(spark, sf).where(F.col("season") != views.PREDICT)
    return plan.prior_period_features(past, views.PREDICT)


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    return plan.roster_attributes(views.roster(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return plan.enrich_full_outer(
        features(spark, sf), attributes(spark, sf), ["player_id", "season"], ["tm", "pos"], required="pos"
    )


def blend(spark: SparkSession, sf: str) -> DataFrame:
    a, b = views.rank_a(spark, sf), views.rank_b(spark, sf)
    return blend_means(a, b, ["player_id", "season"], "adp", "adp", "adp")


def ranking(spark: SparkSession, sf: str) -> DataFrame:
    """The blended list with a team and a position of its own."""
    customer = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("player_id"),
        F.concat(F.lit("T"), (F.col("c_nationkey") % 5).cast("string"), F.lit("X")).alias("tm"),
        F.col("c_mktsegment").alias("pos"),
    )
    return blend(spark, sf).join(customer, "player_id")


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """All steps from season rows to the merged feature table: a derived table, written by
    the first query that needs it and read by all."""
    steps = [
        ("leave out the predicted season", lambda df: df.where(F.col("season") != views.PREDICT)),
        ("prior season", lambda df: plan.prior_period_features(df, views.PREDICT)),
        (
            "rosters",
            lambda df: plan.enrich_full_outer(df, attributes(spark, sf), ["player_id", "season"], ["tm", "pos"], "pos"),
        ),
        (
            "rankings",
            lambda df: plan.stage_merge(df, ranking(spark, sf), ["player_id", "season"], "adp", views.SEGMENTS),
        ),
    ]

    def build() -> DataFrame:
        return plan.run_steps(views.season_aged(spark, sf), steps)

    return derived_table(spark, "staged", [f"{sf}/orders.parquet", f"{sf}/customer.parquet"], build)


@query(
    "SELECT player_id, season, pos, tm, CAST(pts AS DOUBLE) AS pts FROM season",
    "season",
)
def collapse_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return views.season(spark, sf).withColumn("pts", F.col("pts").cast("double"))


@query(
    """SELECT player_id, season, pos, tm, CAST(pts AS DOUBLE) AS pts, age, prv_tm, CAST(prv_pts AS DOUBLE) AS prv_pts,
  prv_season, missing_last, changed_team, year_born FROM features""",
    "features",
)
def prior_period_features(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("pts", "prv_pts")})


@query(
    """SELECT player_id, season, pos, tm, CAST(pts AS DOUBLE) AS pts, age, prv_tm, CAST(prv_pts AS DOUBLE) AS prv_pts,
  prv_season, missing_last, changed_team, year_born, yrs, rookie, draft_pick FROM enriched""",
    "enriched",
)
def enrich_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("pts", "prv_pts")})


@query(
    """SELECT player_id, season, tm, prv_tm, CAST(old_leader AS DOUBLE) AS old_leader, CAST(new_leader AS DOUBLE) AS new_leader,
  CAST(leader_diff AS DOUBLE) AS leader_diff, no_new_leader FROM led""",
    "led",
)
def leader_change(spark: SparkSession, sf: str) -> DataFrame:
    led = plan.leader_change(enriched(spark, sf), views.LEADER)
    return led.select(
        "player_id",
        "season",
        "tm",
        "prv_tm",
        *[F.col(c).cast("double").alias(c) for c in ("old_leader", "new_leader", "leader_diff")],
        "no_new_leader",
    )


@query(
    """SELECT f.player_id, f.season, f.prv_tm, CAST(o.old_leader AS DOUBLE) AS old_leader FROM features f
LEFT JOIN (SELECT tm, season, max(pts) AS old_leader FROM features
  WHERE pos = 'BUILDING' AND tm IS NOT NULL AND right(tm, 2) <> 'TM' GROUP BY 1, 2) o
ON f.prv_tm = o.tm AND f.prv_season = o.season""",
    "features",
)
def prior_group_max(spark: SparkSession, sf: str) -> DataFrame:
    rows = features(spark, sf)
    best = plan.prior_group_max(rows, F.col("pos") == views.LEADER, "tm", "season", "pts", "old_leader")
    best = best.withColumnsRenamed({"tm": "prv_tm", "season": "prv_season"})
    joined = join_to_groups(rows, best, ["prv_tm", "prv_season"])
    return joined.select("player_id", "season", "prv_tm", F.col("old_leader").cast("double").alias("old_leader"))


@query(
    """SELECT e.player_id, e.season, e.tm, e.pos, group_total, group_size,
  CASE WHEN group_total = 0 THEN NULL ELSE CAST(prv_pts AS DOUBLE) / group_total END AS group_share
FROM enriched e LEFT JOIN (
  SELECT tm, pos, season, coalesce(CAST(sum(prv_pts) AS DOUBLE), 0e0) AS group_total, count(*) AS group_size
  FROM enriched WHERE tm IS NOT NULL AND pos IS NOT NULL AND right(tm, 2) <> 'TM' GROUP BY 1, 2, 3) g
ON e.tm = g.tm AND e.pos = g.pos AND e.season = g.season""",
    "enriched",
)
def share_of_group(spark: SparkSession, sf: str) -> DataFrame:
    shared = plan.share_of_group(enriched(spark, sf))
    return shared.select("player_id", "season", "tm", "pos", "group_total", "group_size", "group_share")


@query("SELECT player_id, season, adp FROM blend", "blend")
def blend_rankings(spark: SparkSession, sf: str) -> DataFrame:
    return blend(spark, sf)


@query("SELECT player_id, season, adp FROM blend WHERE season NOT IN (1995, 1996)", "blend")
def variant_rankings(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored lists told apart by how their paths end, the variant's blend of them, and
    the first years left out."""
    folder = new_path(spark, "lists")
    for list_of, variant, end in ((views.rank_a, "PPR", "adp_full.parquet"), (views.rank_b, "NPPR", "adp_nppr_full.parquet")):
        named = list_of(spark, sf).withColumnsRenamed({"season": "Year", "adp": Scoring(variant).ranking})
        overwrite_table(named, f"{folder}/{end}")
    lists = read_by_suffix(spark, [f"{folder}/adp_full.parquet", f"{folder}/adp_nppr_full.parquet"])
    half = Scoring("HPPR")
    out = spelling.rankings_for(half, lists["PPR"], lists["NPPR"], ["player_id", "Year"], (1995, 1996))
    return out.select("player_id", F.col("Year").alias("season"), F.col(half.ranking).alias("adp"))


@query(
    """SELECT player_id, season, CASE tm WHEN 'T0R' THEN 'NUL' WHEN 'T3R' THEN 'TRE' ELSE tm END AS tm, pos, yrs, rookie, draft_pick
FROM attributes WHERE pos IN ('BUILDING', 'FURNITURE')""",
    "attributes",
)
def roster_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Rosters of some positions, with the team codes of another source."""
    rows = views.roster(spark, sf).where(F.col("pos").isin("BUILDING", "FURNITURE"))
    return plan.roster_attributes(rows, team_codes={"T0R": "NUL", "T3R": "TRE"})


@query("SELECT player_id, season FROM season WHERE pos NOT IN ('AUTOMOBILE', 'BUILDING')", "season")
def one_hot_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that are in none of the dummy columns of two positions."""
    rows = views.season(spark, sf).select("player_id", "season", *one_hot("pos", ["AUTOMOBILE", "BUILDING"]))
    return one_hot_violations(rows, ["AUTOMOBILE", "BUILDING"]).select("player_id", "season")


@query("SELECT player_id, season, tm, pos, yrs, rookie, draft_pick FROM attributes", "attributes")
def roster_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return attributes(spark, sf)


STAGED_COLUMNS = """player_id, season, pos, tm, CAST(pts AS DOUBLE) AS pts, age, CAST(prv_pts AS DOUBLE) AS prv_pts, yrs, rookie, adp,
  prv_season, found_rank, adp_sq, drafted, group_total, group_size, group_share,
  "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY\""""


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        "player_id",
        "season",
        "pos",
        "tm",
        F.col("pts").cast("double").alias("pts"),
        "age",
        F.col("prv_pts").cast("double").alias("prv_pts"),
        *["yrs", "rookie", "adp", "prv_season", "found_rank", "adp_sq", "drafted"],
        *["group_total", "group_size", "group_share", *views.SEGMENTS],
    )


@query(f"SELECT {STAGED_COLUMNS} FROM staged", "staged")
def stage_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(staged(spark, sf))


@query(
    """SELECT player_id, season, pos, tm, CAST(pts AS DOUBLE) AS pts, CAST(coalesce(age, 23) AS DOUBLE) AS age, season - 1994 AS adj_year, rookie
FROM staged WHERE season - 1994 > 0 AND season - 1994 < 7 AND found_rank <> 'right_only' AND season <> 2001
  AND pts IS NOT NULL AND rookie IS NOT NULL""",
    "staged",
)
def final_limits(spark: SparkSession, sf: str) -> DataFrame:
    limited = plan.final_limits(staged(spark, sf), views.BASE_YEAR, views.PREDICT)
    age = F.col("age").cast("double").alias("age")
    return limited.select("player_id", "season", "pos", "tm", F.col("pts").cast("double").alias("pts"), age, "adj_year", "rookie")


@query(
    """SELECT player_id, pos, tm, adp, CASE WHEN pos IN ('BUILDING', 'FURNITURE', 'MACHINERY') THEN 1 ELSE 0 END AS flex,
  CAST(NULL AS VARCHAR) AS team, CAST(NULL AS DOUBLE) AS pick
FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY adp IS NULL, adp, pos, tm) AS rn
      FROM merged WHERE season = 2000 AND found_rank IN ('left_only', 'both')) WHERE rn = 1""",
    "merged",
)
def player_pool(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(spark, sf).select("player_id", "season", "pos", "tm", "adp", "found_rank")
    pool = plan.player_pool(rows, 2000, "adp", flex=("BUILDING", "FURNITURE", "MACHINERY"))
    return pool.select("player_id", "pos", "tm", "adp", "flex", "team", "pick")


@query(
    """SELECT player_id, season, round(e / sum(e) OVER (PARTITION BY season), 9) AS probability FROM (
  SELECT *, exp(x - max(x) OVER (PARTITION BY season)) AS e FROM (
    SELECT player_id, season, (301e0 - adp) / 40e0 AS x FROM blend))""",
    "blend",
)
def softmax_group(spark: SparkSession, sf: str) -> DataFrame:
    out = softmax(blend(spark, sf), ["season"], "adp", views.TEMPERATURE)
    return out.select("player_id", "season", F.round("probability", 9).alias("probability"))


@query(
    """SELECT season, sample, player_id, CAST(pick AS INT) AS pick, CAST(floor((pick + 9) / 10.0) AS INT) AS round,
  concat('team_', CAST(CASE WHEN floor((pick + 9) / 10.0) % 2 = 1 THEN (pick - 1) % 10 + 1 ELSE 10 - (pick - 1) % 10 END AS INT)) AS team
FROM (SELECT *, row_number() OVER (PARTITION BY season, sample ORDER BY draw DESC, player_id) AS pick FROM (
  SELECT season, sample, player_id, (301e0 - adp) / 40e0 - ln(-ln((CAST(concat('0x',
    substr(md5(concat('7|', sample, '|', season, '|', player_id)), 1, 8)) AS BIGINT) + 0.5e0) / 4294967296e0)) AS draw
  FROM blend CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS sample))) WHERE pick <= 140""",
    "blend",
)
def sampled_order(spark: SparkSession, sf: str) -> DataFrame:
    drafts = draw_orders(blend(spark, sf), ["season"], "player_id", "adp", views.TEMPERATURE, samples=5, picks=140, seed=7)
    return drafts.select("season", "sample", "player_id", "pick", "round", "team")


def _pick(values: list[str], index: str) -> str:
    """One of the values by a number from 0, as SQL both engines read."""
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


NAMES = ["Steve Smith", "Marvin Jones Jr.", "CJ Anderson", "Robert Griffin III", "Devin Funchess", "Mitch Trubisky", "Odell Beckham II", "A Player"]
CODES = ["GB", "LV", "LAC", "LAR", "KC", "CHI"]
LISTED = f"""SELECT c_custkey, {_pick(NAMES, "c_custkey % 8")} AS "Name",
  {_pick(CODES, "c_nationkey % 6")} AS "Team",
  {_pick(["QB", "RB", "WR", "TE", "K"], "c_custkey % 5")} AS "Position", CAST(2014 + c_nationkey % 7 AS INT) AS "Year" FROM customer"""


@query(
    f"""SELECT c_custkey, CASE WHEN "Name" = 'Steve Smith' THEN 'Steve Smith Sr.' WHEN "Name" = 'Marvin Jones Jr.' THEN 'Marvin Jones'
    WHEN "Name" = 'CJ Anderson' THEN 'C.J. Anderson' WHEN "Name" = 'Mitch Trubisky' THEN 'Mitchell Trubisky'
    WHEN "Name" = 'Odell Beckham II' THEN 'Odell Beckham' ELSE "Name" END AS "Name",
  CASE WHEN "Team" = 'LV' AND "Year" <= 2019 THEN 'OAK' WHEN "Team" = 'LV' THEN 'LVR' WHEN "Team" = 'LAC' AND "Year" <= 2016 THEN 'SDG'
    WHEN "Team" = 'LAR' AND "Year" <= 2015 THEN 'STL' WHEN "Team" = 'GB' THEN 'GNB' WHEN "Team" = 'KC' THEN 'KAN' ELSE "Team" END AS "Team",
  CASE WHEN "Name" = 'Devin Funchess' THEN 'WR' ELSE "Position" END AS "Position", CAST(c_custkey AS VARCHAR) AS "PositionRank", "Year"
FROM ({LISTED}) WHERE "Position" <> 'K'"""
)
def normalise_rankings(spark: SparkSession, sf: str) -> DataFrame:
    """A ranking list made of the customers, in the season table's spelling."""
    listed = views.table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(_pick(NAMES, "c_custkey % 8")).alias("Name"),
        F.expr(_pick(CODES, "c_nationkey % 6")).alias("Team"),
        F.expr(_pick(["QB", "RB", "WR", "TE", "K"], "c_custkey % 5")).alias("Position"),
        (F.col("c_nationkey") % 7 + 2014).alias("Year"),
    )
    ranked = listed.withColumn("PositionRank", F.concat("Position", F.col("c_custkey").cast("string")))
    return spelling.normalise_rankings(ranked)


@query(
    f"""WITH listed AS (SELECT c_custkey, concat("Name", ' ', c_custkey) AS "Name", "Team", "Position", "Year" FROM ({LISTED})),
rules AS (SELECT c_custkey AS rule, concat(' ', c_custkey) AS text, CASE c_custkey % 3 WHEN 0 THEN 'WR' WHEN 1 THEN 'TE' ELSE 'QB' END AS value,
  CASE WHEN c_custkey % 2 = 0 THEN 2017 ELSE 9999 END AS until FROM customer WHERE c_custkey % 4 = 0 AND c_custkey < 4000),
met AS (SELECT listed.c_custkey, arg_max(value, rule) AS value FROM listed JOIN rules ON contains("Name", text) AND "Year" <= until GROUP BY 1),
renamed AS (SELECT c_custkey, concat('No. ', c_custkey) AS value FROM listed WHERE c_custkey % 5 = 0)
SELECT c_custkey, coalesce(r.value, "Name") AS "Name", "Team", coalesce(m.value, "Position") AS "Position", "Year"
FROM listed LEFT JOIN met m USING (c_custkey) LEFT JOIN renamed r USING (c_custkey)"""
)
def rules_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """As many rules as customers: names by equality, positions by a part of the name and the year."""
    key = F.col("c_custkey")
    customer = views.table(spark, sf, "customer")
    listed = customer.select(
        "c_custkey",
        F.concat(F.expr(_pick(NAMES, "c_custkey % 8")), F.lit(" "), key.cast("string")).alias("Name"),
        F.expr(_pick(CODES, "c_nationkey % 6")).alias("Team"),
        F.expr(_pick(["QB", "RB", "WR", "TE", "K"], "c_custkey % 5")).alias("Position"),
        (F.col("c_nationkey") % 7 + 2014).alias("Year"),
    )
    nothing = F.lit(None).cast("int")
    fixed = [F.lit(0).alias("step"), key.cast("long").alias("rule"), F.lit("Name").alias("field")]
    parts = customer.where((key % 4 == 0) & (key < 4000)).select(
        *fixed,
        F.lit("has").alias("how"),
        F.concat(F.lit(" "), key.cast("string")).alias("text"),
        nothing.alias("since"),
        F.when(key % 2 == 0, 2017).otherwise(9999).alias("until"),
        F.lit("Position").alias("target"),
        F.when(key % 3 == 0, "WR").when(key % 3 == 1, "TE").otherwise("QB").alias("value"),
    )
    whole = listed.where(key % 5 == 0).select(
        *fixed, F.lit("is").alias("how"), F.col("Name").alias("text"), nothing.alias("since"), nothing.alias("until"), F.lit("Name").alias("target"), F.concat(F.lit("No. "), key.cast("string")).alias("value")
    )
    return apply_rules(listed, parts.unionByName(whole), ["Name"], ["Name", "Position"], "Year")


FIXED_NAMES = ["Robbie Anderson", "Cordarrelle Patterson", "Ty Montgomery", "Scotty Miller", "Danny Woodhead", "Ladarius Green", "A Player"]


@query(
    f"""WITH listed AS (SELECT {_pick(FIXED_NAMES, "c_custkey % 7")} AS name, CAST(2014 + c_nationkey AS INT) % 10 + 2014 AS year, {_pick(["WR", "RB", "TE"], "c_custkey % 3")} AS pos, c_custkey FROM customer),
r AS (SELECT CASE name WHEN 'Robbie Anderson' THEN 'Chosen Anderson' WHEN 'Scotty Miller' THEN 'Scott Miller' ELSE name END AS name, year,
  CASE WHEN name = 'Cordarrelle Patterson' AND year < 2021 THEN 'WR' WHEN name = 'Ty Montgomery' AND year IN (2016, 2017, 2018) THEN 'RB' ELSE pos END AS pos, min(c_custkey) AS adp
  FROM listed WHERE c_custkey % 2 = 0 GROUP BY 1, 2, 3),
p AS (SELECT CASE name WHEN 'Robbie Anderson' THEN 'Chosen Anderson' WHEN 'Scotty Miller' THEN 'Scott Miller' ELSE name END AS name, year,
  CASE name WHEN 'Danny Woodhead' THEN 'RB' WHEN 'Ladarius Green' THEN 'TE' ELSE pos END AS pos, max(c_custkey) AS pts FROM listed WHERE c_custkey % 3 < 2 GROUP BY 1, 2, 3)
SELECT coalesce(p.name, r.name) AS "Player", coalesce(p.year, r.year) AS "Year", coalesce(p.pos, r.pos) AS "FantPos", pts, adp,
  CASE WHEN r.name IS NULL THEN 'left_only' WHEN p.name IS NULL THEN 'right_only' ELSE 'both' END AS found
FROM p FULL JOIN r ON p.name = r.name AND p.year = r.year AND p.pos = r.pos"""
)
def merge_fixups(spark: SparkSession, sf: str) -> DataFrame:
    """Rankings met with a season table, once both spell names and positions alike."""
    customer = views.table(spark, sf, "customer")
    listed = customer.select(
        F.expr(_pick(FIXED_NAMES, "c_custkey % 7")).alias("Name"),
        ((F.col("c_nationkey") + 2014) % 10 + 2014).cast("int").alias("Year"),
        F.expr(_pick(["WR", "RB", "TE"], "c_custkey % 3")).alias("Position"),
        "c_custkey",
    )
    rankings = spelling.match_season_names(listed.where("c_custkey % 2 = 0")).groupBy("Name", "Year", "Position").agg(F.min("c_custkey").alias("adp"))
    scored = listed.where("c_custkey % 3 < 2").withColumnsRenamed({"Name": "Player", "Position": "FantPos"})
    scored = map_values(spelling.match_ranking_positions(scored), "Player", spelling.MERGE_NAMES)
    scored = scored.groupBy("Player", "Year", "FantPos").agg(F.max("c_custkey").alias("pts"))
    return join_indicator(scored, rankings.withColumnsRenamed({"Name": "Player", "Position": "FantPos"}), ["Player", "Year", "FantPos"])


@query(
    """SELECT l_orderkey, l_linenumber, p_name AS "Player", p_type AS "FantPos",
  l_quantity * 4e-2 + 0e0 * 4e0 + CAST(l_linenumber AS DOUBLE) * -2e0 + coalesce(l_discount, 0e0) * 1e-1 + 0e0 * 6e0
    + 0e0 * 1e-1 + 0e0 * 6e0 + 0e0 * -2e0 + 0e0 * 2e0 + 0e0 * 2e0 + l_tax * 5e-1 AS "Pts_HPPR"
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'SMALL'"""
)
def season_points(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as season stat rows in text, with header rows among them."""
    scoring = Scoring("HPPR")
    given = {"PassYds": "l_quantity", "PassInt": "l_linenumber", "RushYds": "l_discount", "Rec": "l_tax"}
    part = views.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    lines = views.table(spark, sf, "lineitem").join(part, "l_partkey")
    empty = F.lit(None).cast("string")
    texts = [(F.col(given[c]).cast("string") if c in given else empty).alias(c) for c in [*scoring.weights, "FantPt", "PPR"]]
    stats = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.lit("1").alias("Rk"),
        F.explode(F.array(F.concat("p_name", F.lit("*+")), F.lit("Player"))).alias("Player"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("FantPos"),
        *texts,
    )
    out = score_season_stats(stats, scoring)
    return out.select("l_orderkey", "l_linenumber", "Player", "FantPos", scoring.points)
