import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from seasonlab.plans import regression as ml


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = 2 * x[:, 0] - x[:, 1] * x[:, 0] + 0.1 * rng.normal(size=600) + 5
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, y double").persist()


def test_penalised_weights_equal_sparks(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, size=(400, 5))
    x[:, 4] = 0.7 * x[:, 0] + 0.3 * x[:, 4]
    y = 3 * x[:, 0] - 2 * x[:, 2] + rng.normal(scale=0.2, size=400)
    sums = np.column_stack([np.ones(400), y, x])
    cov, by_y, _ = ml.centred(sums.T @ sums)
    df = spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "label"])
    for alpha in (0.5, 0.05, 0.005):
        w = ml.shrink(cov, by_y, alpha, np.zeros(5))
        fit = LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False, solver="normal").fit(df)
        assert w == pytest.approx(fit.coefficients.toArray(), abs=2e-4)


def test_sums_of_products_per_fold(spark, table):
    prepared = ml.Pipeline(stages=ml.feature_stages(["a", "b"], 1)).fit(table).transform(table)
    prepared = prepared.select("_features", "y", (F.col("id") % 2).alias("_fold"))
    total = np.sum(ml.moments(prepared, "y", 2), axis=0)
    rows = np.array([[1.0, r.y, *r._features] for r in prepared.collect()])
    assert total == pytest.approx(rows.T @ rows)


def test_squared_error_from_sums():
    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=(50, 2)), rng.normal(size=50), np.array([0.5, -2.0])
    rows = np.column_stack([np.ones(50), y, x])
    assert ml.squared_error(rows.T @ rows, w, 1.5) == pytest.approx(np.mean((y - 1.5 - x @ w) ** 2))


def test_weights_that_do_not_settle_are_an_error():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 6))
    cov = x.T @ x / 50
    with pytest.raises(RuntimeError):
        ml.shrink(cov, cov.sum(axis=1), 1e-6, np.zeros(6), most=3)


def test_whole_grid_is_walked(monkeypatch, table):
    seen = []
    real = ml.shrink
    monkeypatch.setattr(ml, "shrink", lambda cov, by_y, alpha, w: seen.append(alpha) or real(cov, by_y, alpha, w))
    ml.fit_split(table, "y", ["a"], ["id"], 1)
    assert len(set(seen)) == 100 and len(seen) == 500


def test_fit_finds_the_product_term(table):
    flat = ml.fit_split(table, "y", ["a", "b", "c"], ["id"], 1)
    bent = ml.fit_split(table, "y", ["a", "b", "c"], ["id"], 2)
    assert bent.test_r2 > 0.98 > flat.test_r2 + 0.05
    assert ml.score(bent.model, table, "y") > 0.98


def test_missing_values_take_the_mean(spark, table):
    holes = table.withColumn("a", F.when(F.col("id") % 10 != 0, F.col("a")))
    fit = ml.fit_split(holes, "y", ["a", "b", "c"], ["id"], 2)
    out = ml.predict(fit.model, holes, ["a", "b", "c"])
    assert out.columns == [*holes.columns, "prediction"] and out.where("prediction is null").count() == 0


def test_constant_outcome(spark, table):
    fit = ml.fit_split(table.withColumn("y", F.lit(3.0)), "y", ["a"], ["id"], 1)
    assert fit.alpha == 0.0 and fit.test_r2 is None


def test_two_stages_score_every_listed_row(table):
    rated = table.withColumn("adp", F.col("id").cast("double"))
    train = rated.where("id < 400")
    everything = rated.withColumn("y", F.when(F.col("id") < 500, F.col("y")))
    out, mean_fit, error_fit = ml.two_stage_fit(train, everything, "y", ["a", "b", "c"], "adp", ["id"], (2, 1), 550)
    assert out.count() == 550 and out.where("var_pred is null or pred is null").count() == 0
    assert out.where("var is null").count() == 50
    assert out.where("abs(var2 - var * var) > 1e-9").count() == 0 and mean_fit.test_r2 > 0.9


def test_models_per_group_survive_saving(spark, table, tmp_path):
    names = ml.group_features("RB", ["RB"])
    assert len(names) == 7 and len(ml.group_features("QB", ["RB"])) == 5
    df = table.select(
        "id",
        F.when(F.col("id") % 2 == 0, "RB").otherwise("QB").alias("pos"),
        *[F.col("abc"[i % 3]).alias(n) for i, n in enumerate(names)],
        F.col("y"),
    ).withColumn("team", F.floor(F.col("id") / 2))
    fits = ml.models_by_group(df, "y", ["RB", "QB"], ["RB"], ["team"], 2)
    ml.save_models({k: f.model for k, f in fits.items()}, str(tmp_path))
    loaded = ml.load_models(str(tmp_path), ["RB", "QB"])
    ours = ml.group_predictor({k: f.model for k, f in fits.items()})(df)
    theirs = ml.group_predictor(loaded)(df)
    assert ours.count() == 600 and ours.exceptAll(theirs).count() == 0
    assert ml.overall_r2(df, loaded, "y", ["team"]).first()["r2"] > 0.9


def test_sweep_logs_a_row_per_degree(spark, table):
    log, fits = ml.degree_sweep(spark, {"S": ("some", table, ["a", "b"], (1, 2))}, "y", ["id"])
    assert [tuple(r)[:3] for r in log.collect()] == [("S", "some", "lasso_poly1"), ("S", "some", "lasso_poly2")]
    assert set(fits) == {("S", 1), ("S", 2)}


def test_position_sweep_closes_with_the_sums(spark, table):
    names = ml.group_features("QB", [])
    df = table.select(
        F.floor(F.col("id") / 2).alias("team"),
        F.when(F.col("id") % 2 == 0, "QB").otherwise("FLEX").alias("pos"),
        *[F.col("abc"[i % 3]).alias(n) for i, n in enumerate(names)],
        "y",
    )
    log, fits = ml.position_sweep(spark, df, "y", ["QB", "FLEX"], [], ["team"], (1, 2))
    rows = [(r.Model, r.Position, r.TestR2) for r in log.collect()]
    assert [r[:2] for r in rows] == [(f"lasso_poly{d}", p) for d in (1, 2) for p in ("QB", "FLEX", "Aggregated")]
    assert rows[5][2] > rows[2][2] and rows[5][2] > 0.9


def test_many_features_are_summed_and_walked_in_tasks(spark, table, monkeypatch):
    """The same penalty as on the driver, which gets no sums of products."""
    prepared = ml.Pipeline(stages=ml.feature_stages(["a", "b", "c"], 3)).fit(table).transform(table)
    prepared = prepared.select("_features", "y", (F.col("id") % 5).cast("int").alias("_fold")).repartition(3)
    lines = ml.moment_lines(prepared, "y").toPandas()
    total = np.sum([ml.whole_sums(part) for _, part in lines.groupby("fold")], axis=0)
    assert total == pytest.approx(np.sum(ml.moments(prepared, "y", 5), axis=0))
    assert ml.choose_wide_penalty(prepared, "y") == pytest.approx(ml.choose_penalty(prepared, "y"))
    assert ml.choose_wide_penalty(prepared.withColumn("y", F.lit(3.0)), "y") == ml.choose_wide_penalty(prepared.where("_fold = 1"), "y") == 0.0
    monkeypatch.setattr(ml, "DRIVER_TERMS", 3)
    monkeypatch.setattr(ml, "moments", None)
    assert ml.fit_split(table, "y", ["a", "b", "c"], ["id"], 2).test_r2 > 0.98


def test_products_of_features_are_not_kept(table, monkeypatch):
    """Stored products of a partition are many times the partition."""
    kept = []
    real = type(table).persist
    monkeypatch.setattr(type(table), "persist", lambda df, *a: kept.append(df.columns) or real(df, *a))
    ml.fit_split(table, "y", ["a", "b"], ["id"], 3)
    assert kept and not any("_features" in c for c in kept)
