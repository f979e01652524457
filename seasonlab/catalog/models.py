"""Regressions on the season table and on roster profiles.

The models of degree 1 are solved again in SQL, cross-validation included. For wider ones
SQL tells the rows, terms and largest useful penalty from the data, and the query whether
the stored weights meet the conditions of the optimum. Times are in the logs that
:mod:`seasonlab.plans.regression` makes, not in the results of queries, which are the
same in every run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import comb

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog import views
from seasonlab.catalog.profiles import BY, POSITIONS, usable_set
from seasonlab.catalog.registry import query
from seasonlab.catalog.seasons import staged
from seasonlab.functions import amount
from seasonlab.operators import r2
from seasonlab.plans import model_table as tables
from seasonlab.plans import profile as profiles
from seasonlab.plans import regression as ml
from seasonlab.plans.sampling import bucket_of, train_test
from seasonlab.plans.season import add_final_fields, final_limits
from seasonlab.session import derived_table, new_path
from seasonlab.sources import append_table, read_tables

SEASON_FEATURES = ["age", "adj_year", "drafted", "group_total", "group_size", "adp", "rookie", "yrs", *views.SEGMENTS]
TWO_STARTERS = ["LARGE", "MEDIUM"]


ALL_POSITIONS = [*POSITIONS, "FLEX"]


def complete_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of the leagues in which every team has its starters, with a known outcome:
    a derived table, since every fit reads it several times. The outcome of the flex slot
    is what the team shipped of types that have no slot of their own."""

    def build() -> DataFrame:
        spare = views.outcomes(spark, sf).where(~F.col("pos").isin(POSITIONS))
        spare = spare.groupBy(*BY).agg(F.sum(amount("pts")).cast("double").alias("_spare"))
        rows = usable_set(spark, sf).join(spare, BY, "left")
        rows = rows.withColumn("pts", F.when(F.col("pos") == "FLEX", F.col("_spare")).otherwise(F.col("pts")))
        return rows.where(F.col("pts").isNotNull()).drop("_spare")

    return derived_table(spark, "profiles", [f"{sf}/{t}.parquet" for t in ("lineitem", "part")], build)


UNUSED = {p: ["b_pred_points", "b_std_error"] for p in ALL_POSITIONS if p not in TWO_STARTERS}


def position_models(spark: SparkSession, sf: str, degree: int) -> DataFrame:
    """The table of all positions' models, fitted at once and stored by the first query that needs it."""

    def build() -> DataFrame:
        train, _ = train_test(complete_profiles(spark, sf), BY)
        return tables.fit_models(train, "pos", "pts", profiles.MEASURES, tables.fold_of(BY), degree, UNUSED)

    return derived_table(spark, f"position-models-{degree}", [f"{sf}/{t}.parquet" for t in ("lineitem", "part")], build)


def by_position(spark: SparkSession, sf: str, degree: int = 1) -> Callable[[DataFrame], DataFrame]:
    """A function that adds every row's prediction by its position's stored model."""
    models = position_models(spark, sf, degree)
    return lambda df: tables.predict_by_group(df, models, "pos", profiles.MEASURES, degree, UNUSED)


def optimal_fits(spark: SparkSession, sf: str, degree: int) -> DataFrame:
    train, _ = train_test(complete_profiles(spark, sf), BY)
    found = tables.certificates(train, position_models(spark, sf, degree), "pos", "pts", profiles.MEASURES, degree, UNUSED)
    return found.select(
        F.lit(degree).alias("degree"), "pos", "n", "terms", F.round("top_penalty", 6).alias("top_penalty"), "optimal"
    )


def _optimal_sql(degree: int) -> str:
    """Rows, terms and the largest useful penalty of each position's model, from the data
    alone; that the stored weights are the optimum is what the query finds out."""
    products = {
        1: "x",
        2: "x || flatten([[x[i] * x[j] for j in range(i, 8)] for i in range(1, 8)])",
        3: "x || flatten([[x[i] * x[j] for j in range(i, 8)] for i in range(1, 8)])"
        " || flatten(flatten([[[x[i] * x[j] * x[k] for k in range(j, 8)] for j in range(i, 8)] for i in range(1, 8)]))",
    }[degree]
    return f"""SELECT {degree} AS degree, pos, any_value(n) AS n, CAST(count(*) AS BIGINT) AS terms, round(max(CASE WHEN v > 1e-12 THEN abs(c) ELSE 0e0 END), 6) AS top_penalty, TRUE AS optimal
FROM (SELECT pos, i, count(*) AS n, covar_pop(t[i], y) / greatest(max(abs(t[i])), 1e-300) AS c, var_pop(t[i]) / greatest(max(abs(t[i])) * max(abs(t[i])), 1e-300) AS v
  FROM (SELECT pos, y, {products} AS t FROM known_set WHERE is_train), unnest(range(1, len(t) + 1)) g(i) GROUP BY 1, 2) GROUP BY pos"""


@query(_optimal_sql(2), "known_set")
def fit_poly_lasso(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of each roster position from its profile, degree 2: all positions from one
    keyed aggregation, the penalty by cross-validation, and whether each is the optimum."""
    return optimal_fits(spark, sf, 2)


@query(
    """SELECT CAST(count(*) AS BIGINT) AS teams, round(regr_slope(pts, final_pred_points), 6) AS slope,
  round(regr_intercept(pts, final_pred_points), 3) AS intercept, round(regr_r2(pts, final_pred_points), 6) AS r2
FROM (SELECT league, team, CAST(sum(pts) AS DOUBLE) AS pts, CAST(sum(CAST(a_pred_points AS DECIMAL(18,2)))
  + sum(CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN CAST(b_pred_points AS DECIMAL(18,2)) END) AS DOUBLE) AS final_pred_points FROM usable_set GROUP BY 1, 2)""",
    "usable_set",
)
def line_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Unpenalised line through the team outcomes by their starters' predicted points."""
    inputs = [f"{sf}/{t}.parquet" for t in ("lineitem", "part")]
    # a derived table: a row per team, read by the count, the fit and its quality
    rows = derived_table(spark, "starter-points", inputs, lambda: profiles.starter_points(usable_set(spark, sf), BY, "pts", tuple(TWO_STARTERS)))
    teams = rows.count()
    slope = intercept = None  # as in SQL, nothing is told by no rows
    if teams:
        vectors = VectorAssembler(inputCols=["final_pred_points"], outputCol="_features").transform(rows)
        line = LinearRegression(featuresCol="_features", labelCol="pts", solver="normal").fit(vectors)
        slope, intercept = float(line.coefficients[0]), float(line.intercept)
    slope, intercept = (F.lit(v).cast("double") for v in (slope, intercept))
    found = rows.select("pts", (intercept + slope * F.col("final_pred_points")).alias("prediction"))
    return r2(found, "pts", "prediction").select(
        F.lit(teams).cast("long").alias("teams"),
        F.round(slope, 6).alias("slope"),
        F.round(intercept, 3).alias("intercept"),
        F.round("r2", 6).alias("r2"),
    )


def _season_points(spark: SparkSession, sf: str) -> tuple[DataFrame, ml.Fit, ml.Fit]:
    stage = staged(spark, sf)
    train = final_limits(stage, views.BASE_YEAR, views.PREDICT)
    return ml.two_stage_fit(train, add_final_fields(stage, views.BASE_YEAR), "pts", SEASON_FEATURES, "adp", ["player_id", "season"], (3, 2))


@query()
def two_stage_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Season points and their variance for every entity-season."""
    scored, _, _ = _season_points(spark, sf)
    return scored.select("player_id", "season", "adp", "pred", "var", "var2", "var_pred")


@query(
    f"""SELECT stage, n, CAST(terms AS BIGINT) AS terms, TRUE AS optimal FROM (
  SELECT count(*) AS n FROM staged WHERE season - {views.BASE_YEAR} > 0 AND season < {views.PREDICT} AND found_rank <> 'right_only' AND pts IS NOT NULL AND rookie IS NOT NULL
    AND CAST(concat('0x', substr(md5(concat('_', CAST(player_id AS VARCHAR), '_', CAST(season AS VARCHAR))), 1, 8)) AS BIGINT) % 100 < 80)
CROSS JOIN (VALUES ('outcome', {comb(len(SEASON_FEATURES) + 3, 3) - 1}), ('squared error', {comb(len(SEASON_FEATURES) + 3, 2) - 1})) s(stage, terms) WHERE n > 0""",
    "staged",
)
def two_stage_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the outcome's model, and that of its squared error, are optimal on what they were fitted on."""
    stage = final_limits(staged(spark, sf), views.BASE_YEAR, views.PREDICT)
    _, outcome, error = _season_points(spark, sf)
    train, _ = train_test(stage, ["player_id", "season"])
    first = ml.predict(outcome.model, train, SEASON_FEATURES).withColumnRenamed("prediction", "pred")
    second = first.withColumn("var2", F.pow(F.col("pts").cast("double") - F.col("pred"), 2.0))
    parts = [("outcome", tables.optimality_of(outcome, train, "pts")), ("squared error", tables.optimality_of(error, second, "var2"))]
    return reduce(DataFrame.unionByName, [found.select(F.lit(name).alias("stage"), "n", "terms", "optimal") for name, found in parts])


def _sweep_sets(spark: SparkSession, sf: str) -> dict[str, tuple]:
    rows = complete_profiles(spark, sf)
    starter = profiles.starter_points(rows, BY, "pts", tuple(TWO_STARTERS))
    line = profiles.pivot_features(rows, BY, "pts", views.PICK_SLOTS)
    simple = profiles.pivot_stats(rows, BY, "pts", POSITIONS)
    return {
        "Starter": ("predicted points of starters", starter, ["final_pred_points"], (1, 2, 3)),
        "OneLine": ("all profile measures in one row", line, [c for c in line.columns if c not in (*BY, "pts")], (1, 2, 3)),
        "Simple": ("average and spread per position", simple, [c for c in simple.columns if c not in (*BY, "pts")], (1, 2)),
    }


_LINE = 7 * len(POSITIONS) - 2 * (len(POSITIONS) - len(TWO_STARTERS))
_SETS = [("Starter", 1, 3), ("OneLine", _LINE, 3), ("Simple", 3 * len(POSITIONS), 2)]
_SWEEP = ", ".join(f"('{name}', 'lasso_poly{d}', {comb(x + d, d) - 1})" for name, x, most in _SETS for d in range(1, most + 1))


@query(
    f"""SELECT name AS "Name", model AS "Model", n, CAST(terms AS BIGINT) AS terms, TRUE AS optimal FROM (VALUES {_SWEEP}) s(name, model, terms)
CROSS JOIN (SELECT count(DISTINCT (league, team)) AS n FROM known_set WHERE is_train) WHERE n > 0""",
    "known_set",
)
def degree_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Starter, one-line and simple feature sets at several degrees: rows, terms and whether each fit is the optimum."""
    sets = _sweep_sets(spark, sf)
    _, fits = ml.degree_sweep(spark, sets, "pts", BY)
    rows = []
    for (name, degree), fit in fits.items():
        train, _ = train_test(sets[name][1], BY)
        found = tables.optimality_of(fit, train, "pts")
        rows.append(found.select(F.lit(name).alias("Name"), F.lit(f"lasso_poly{degree}").alias("Model"), "n", "terms", "optimal"))
    return reduce(DataFrame.unionByName, rows)


@query(" UNION ALL ".join(f"({_optimal_sql(d)})" for d in (1, 2, 3)), "known_set")
def position_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Every position at degrees 1 to 3, each degree in one pass."""
    return reduce(DataFrame.unionByName, [optimal_fits(spark, sf, d) for d in (1, 2, 3)])


def quality(rows: DataFrame, keys: list[str]) -> DataFrame:
    """R² per key of ``prediction`` for ``pts``, one column for training rows and one for others."""
    train = F.when(bucket_of(BY) < 80, True)
    y, p = F.col("pts").cast("double"), F.col("prediction")

    def r2_of(part: Column) -> Column:
        return 1 - F.try_divide(F.sum(F.when(part, (y - p) * (y - p))), F.var_pop(F.when(part, y)) * F.count(F.when(part, y)))

    return rows.groupBy(*keys).agg(r2_of(train).alias("TrainR2"), r2_of(train.isNull()).alias("TestR2"))


@query(
    """WITH scored AS (SELECT league, team, pos, y, is_train, intercept + list_dot_product(w, [x[j] / scale[j] for j in range(1, 8)]) AS p FROM known_set JOIN models USING (pos)),
sums AS (SELECT league, team, sum(y) AS y, sum(p) AS p, any_value(is_train) AS is_train FROM scored GROUP BY 1, 2),
rows AS (SELECT pos, y, p, is_train FROM scored UNION ALL SELECT 'Aggregated', y, p, is_train FROM sums)
SELECT 'ByPositionLinear' AS "Name", 'a regression on each position' AS "Description", 'lasso_poly1' AS "Model", pos AS "Position",
  round(1 - sum((y - p) * (y - p)) FILTER (is_train) / (var_pop(y) FILTER (is_train) * count(*) FILTER (is_train)), 6) AS "TrainR2",
  round(1 - sum((y - p) * (y - p)) FILTER (NOT is_train) / (var_pop(y) FILTER (NOT is_train) * count(*) FILTER (NOT is_train)), 6) AS "TestR2"
FROM rows GROUP BY pos""",
    "models",
)
def results_log(spark: SparkSession, sf: str) -> DataFrame:
    """A stored log to which fits append their rows: each position's, then that of the teams' sums."""
    scored = by_position(spark, sf)(complete_profiles(spark, sf))
    sums = scored.groupBy(*BY).agg(F.sum(amount("pts")).cast("double").alias("pts"), F.sum(amount("prediction")).cast("double").alias("prediction"))
    path = new_path(spark, "results-log")
    for found in (quality(scored, ["pos"]), quality(sums, []).withColumn("pos", F.lit("Aggregated")).where("TrainR2 IS NOT NULL")):
        append_table(ml.log_of(found, "ByPositionLinear", "a regression on each position", 1), path)
    return read_tables(spark, path).drop("TimeToFinish").withColumns({c: F.round(c, 6) for c in ("TrainR2", "TestR2")})


@query(
    """SELECT league, team, round(sum(intercept + list_dot_product(w, [x[j] / scale[j] for j in range(1, 8)])), 4) AS total
FROM known_set JOIN models USING (pos) GROUP BY 1, 2""",
    "models",
)
def models_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """A model per position, stored as a table, read again and added up to team totals."""
    total = profiles.score_teams(complete_profiles(spark, sf), by_position(spark, sf), BY)
    return total.withColumn("total", F.round("total", 4))


@query(
    """SELECT pos, n, round(penalty, 8) AS penalty, round(top, 8) AS top_penalty, round(intercept, 4) AS intercept, j AS term, round(w[j], 4) AS weight
FROM models, range(1, 8) t(j)""",
    "models",
)
def model_weights(spark: SparkSession, sf: str) -> DataFrame:
    """The stored models themselves: penalty, intercept and the weight of each scaled feature."""
    rounded = [F.round("penalty", 8).alias("penalty"), F.round("top_penalty", 8).alias("top_penalty"), F.round("intercept", 4).alias("intercept")]
    rows = position_models(spark, sf, 1).select("pos", "n", *rounded, F.posexplode("weights").alias("at", "w"))
    return rows.select("pos", "n", "penalty", "top_penalty", "intercept", (F.col("at") + 1).cast("long").alias("term"), (F.round("w", 4) + 0.0).alias("weight"))


_FEATURES_SQL = """[a_pred_points, a_std_error, CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN b_pred_points ELSE 0e0 END,
  CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN b_std_error ELSE 0e0 END, CAST(num_others AS DOUBLE), avg_pred_points_other, avg_std_error_other]"""


@query(
    f"""SELECT d.league, d.team, d.player_id, d.pos, t.total FROM drafted d JOIN (
  SELECT league, team, round(sum(intercept + list_dot_product(w, [x[j] / scale[j] for j in range(1, 8)])), 4) AS total
  FROM (SELECT league, team, pos, {_FEATURES_SQL} AS x FROM profiles) LEFT JOIN models USING (pos) GROUP BY 1, 2) t USING (league, team)""",
    "models",
    "profiles",
    "drafted",
)
def score_picks_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Every pick with the total that the stored models predict for its team; null without models."""
    members = views.drafted(spark, sf)
    scored = profiles.score_picks(members, profiles.group_profile(members, views.PICK_SLOTS), by_position(spark, sf), BY)
    return scored.select(*BY, "player_id", "pos", F.round("total", 4).alias("total"))


def _measured(rn: str, mine: str) -> str:
    """Features of a position, from its members numbered by ``rn`` among those of ``mine``."""
    rest = f"CASE WHEN {mine} AND {rn} > q THEN {{}} END"
    count = f"count(CASE WHEN {mine} THEN 1 END)"
    mean = "coalesce(CAST(sum({0}) AS DOUBLE) / nullif(count({0}), 0), {1})"
    two = f"CASE WHEN any_value(q) = 2 THEN coalesce(max(CASE WHEN {mine} AND {rn} = 2 THEN {{}} END), {{}}) ELSE 0e0 END"
    one = f"coalesce(max(CASE WHEN {mine} AND {rn} = 1 THEN {{}} END), {{}})"
    cells = [one.format("pred", "0e0"), one.format("var_pred", "1e4"), two.format("pred", "0e0"), two.format("var_pred", "1e4")]
    cells += [f"CAST({count} - any_value(q) AS DOUBLE)", mean.format(rest.format("CAST(pred AS DECIMAL(18,2))"), "0e0"), mean.format(rest.format("CAST(var_pred AS DECIMAL(18,2))"), "1e4")]
    return "[" + ", ".join(cells) + "]"


@query(
    f"""WITH mine AS (SELECT league, player_id, pos, pred, var_pred FROM drafted WHERE team = 'team_1'),
cand AS (SELECT league, team, player_id, pos, pred, var_pred, row_number() OVER () AS c
  FROM drafted WHERE team <> 'team_1' AND pos IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')),
both_lists AS (SELECT c, cand.pos, mine.player_id, mine.pred, mine.var_pred, 0 AS own FROM cand JOIN mine USING (league, pos)
  UNION ALL SELECT c, pos, player_id, pred, var_pred, 1 FROM cand),
placed AS (SELECT *, CASE WHEN pos IN ('LARGE', 'MEDIUM') THEN 2 ELSE 1 END AS q,
  row_number() OVER (PARTITION BY c ORDER BY pred DESC, player_id) AS after_rn,
  row_number() OVER (PARTITION BY c ORDER BY own, pred DESC, player_id) AS before_rn FROM both_lists),
measured AS (SELECT c, {_measured("after_rn", "TRUE")} AS after_x, {_measured("before_rn", "own = 0")} AS before_x FROM placed GROUP BY 1)
SELECT league, team, player_id, pos, round(list_dot_product(w, [(after_x[j] - before_x[j]) / scale[j] for j in range(1, 8)]), 4) AS value_add
FROM cand JOIN measured USING (c) LEFT JOIN models USING (pos)""",
    "models",
    "drafted",
)
def value_added_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """What any other team's member would add to team_1 of the same league, by the stored models."""
    members = views.drafted(spark, sf)
    out = profiles.value_added(members.where("team <> 'team_1'"), members.where("team = 'team_1'"), views.PICK_SLOTS, by_position(spark, sf))
    return out.select(*BY, "player_id", "pos", (F.round("value_add", 4) + 0.0).alias("value_add"))
