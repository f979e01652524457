"""Models of all groups at once against one fit at a time, and their certificates."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from seasonlab.plans import model_table as t
from seasonlab.plans import regression as ml

XS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Group A follows a product, B a line; a third of all rows is in A; some values are missing."""
    rng = np.random.default_rng(0)
    data = []
    for i in range(900):
        a, b, c = map(float, rng.normal(size=3))
        key = "A" if i % 3 == 0 else "BCD"[(i % 3 + i % 2) % 3]
        y = {"A": 2 * a - a * b + 5, "B": 3 * c - 1, "C": 0.5 * a, "D": 7.0}[key] + (0.1 * float(rng.normal()) if key != "D" else 0)
        data.append((i, key, a if i % 20 else None, b if i % 25 else float("nan"), c, y))
    data += [(900, None, 1.0, 1.0, 1.0, 1.0), (901, "A", 1.0, 1.0, 1.0, None), (902, "E", None, None, None, 4.0)]
    return spark.createDataFrame(data, "id int, g string, a double, b double, c double, y double").persist()


def fitted(rows, spark, tmp_path, degree=1, **options):
    path = str(tmp_path / f"models-{degree}-{len(options)}")
    t.fit_models(rows, "g", "y", XS, t.fold_of(["id"]), degree, **options).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("degree", [1, 2, 3])
def test_every_group_is_optimal(rows, spark, tmp_path, degree):
    models = fitted(rows, spark, tmp_path, degree)
    assert {r.g: r.n for r in models.collect()} == {r["g"]: r["count"] for r in rows.where("g IS NOT NULL AND y IS NOT NULL").groupBy("g").count().collect()}
    found = {r.g: r for r in t.certificates(rows, models, "g", "y", XS, degree).collect()}
    assert all(r.optimal and r.terms == [3, 9, 19][degree - 1] for r in found.values()) and set(found) == set("ABCDE")
    assert found["D"].used == 0 and found["E"].used == 0 and found["A"].used > 0


def test_moved_weights_are_not_optimal(rows, spark, tmp_path):
    models = fitted(rows, spark, tmp_path)
    for change in (F.transform("weights", lambda w: w * 1.01), F.transform("weights", lambda w: w + 0.01)):
        found = {r.g: r.optimal for r in t.certificates(rows, models.withColumn("weights", change), "g", "y", XS).collect()}
        assert not found["A"] and not found["B"]
    assert not any(r.optimal for r in t.certificates(rows.where("g < 'D'"), models.withColumn("intercept", F.col("intercept") + 1), "g", "y", XS).collect())


def test_weights_equal_one_fit_by_spark(rows, spark, tmp_path):
    models = {r.g: r for r in fitted(rows, spark, tmp_path, penalty=0.05).collect()}
    own = [r for r in rows.where("g = 'B' AND a IS NOT NULL AND NOT isnan(b)").collect()]
    only = fitted(rows.where("g = 'B' AND a IS NOT NULL AND NOT isnan(b)"), spark, tmp_path / "own", penalty=0.05).first()
    x = np.array([[r.a, r.b, r.c] for r in own])
    scale = np.abs(x).max(axis=0)
    df = spark.createDataFrame([(Vectors.dense(v), r.y) for v, r in zip(x / scale, own)], ["features", "label"])
    fit = LinearRegression(regParam=0.05, elasticNetParam=1.0, standardization=False, solver="normal", maxIter=1000, tol=1e-10).fit(df)
    assert only.weights == pytest.approx(fit.coefficients.toArray().tolist(), abs=1e-4) and only.scales == pytest.approx(scale.tolist())
    assert only.intercept == pytest.approx(fit.intercept, abs=1e-4) and only.penalty == 0.05 and models["B"].n > only.n


def test_predictions_keep_rows_and_columns(rows, spark, tmp_path):
    models = fitted(rows, spark, tmp_path, 2)
    more = rows.unionByName(spark.createDataFrame([(950, "Z", 1.0, 1.0, 1.0, 2.0)], rows.schema)).withColumn("prediction", F.lit("old"))
    out = t.predict_by_group(more, models, "g", XS, 2)
    assert out.columns == more.columns and out.count() == 904
    none = {r.id for r in out.where("prediction IS NULL").collect()}
    assert none == {900, 950}
    r2 = out.where("g = 'A' AND y IS NOT NULL").agg(1 - F.sum((F.col("y") - F.col("prediction")) ** 2) / (F.var_pop("y") * F.count("y"))).first()[0]
    assert r2 > 0.9


def test_features_that_a_group_does_not_use(rows, spark, tmp_path):
    models = {r.g: r for r in fitted(rows, spark, tmp_path, unused={"B": ["c"]}).collect()}
    assert models["B"].weights[2] == 0 and models["B"].means[2] is None and models["A"].means[2] is not None
    table = fitted(rows, spark, tmp_path, unused={"B": ["c"]})
    moved = rows.withColumn("c", F.when(F.col("g") == "B", 1e6).otherwise(F.col("c")))
    one, two = (t.predict_by_group(r, table, "g", XS, 1, {"B": ["c"]}).select("id", "prediction") for r in (rows, moved))
    assert one.exceptAll(two).count() == 0


def test_sums_handed_on_early_are_the_same(rows, spark, tmp_path, monkeypatch):
    whole = {r.g: r for r in fitted(rows, spark, tmp_path, 2).collect()}
    monkeypatch.setattr(t, "HELD_MB", 0)
    for r in fitted(rows.repartition(7), spark, tmp_path / "small", 2).collect():
        assert r.weights == pytest.approx(whole[r.g].weights, abs=1e-7) and r.penalty == pytest.approx(whole[r.g].penalty)


def test_penalty_is_the_best_of_the_grid():
    """Against a walk of every fold and penalty on the rows themselves."""
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, size=(200, 4))
    y = x[:, 0] + rng.normal(scale=1.0, size=200)
    fold = np.arange(200) % 5
    by_fold = [(lambda v: v.T @ v)(np.column_stack([np.ones((fold == f).sum()), y[fold == f], x[fold == f]])) for f in range(5)]
    penalty, top, intercept, w = t.best_fit(by_fold, 20)
    errors = []
    for alpha in top * np.logspace(0, -3, 20):
        error = 0.0
        for f in range(5):
            tr, te = fold != f, fold == f
            cov = np.cov(x[tr].T, bias=True)
            by = ((x[tr] - x[tr].mean(0)) * (y[tr] - y[tr].mean())[:, None]).mean(0)
            v = ml.shrink(cov, by, alpha, np.zeros(4))
            error += np.mean((y[te] - y[tr].mean() - (x[te] - x[tr].mean(0)) @ v) ** 2)
        errors.append(error)
    assert penalty == pytest.approx((top * np.logspace(0, -3, 20))[int(np.argmin(errors))])
    assert intercept == pytest.approx(y.mean() - x.mean(0) @ w)


def test_pipelines_are_certified_too(rows):
    known = rows.where("g = 'A' AND y IS NOT NULL")
    fit = ml.fit_poly_lasso(known, known, "y", XS, 2)
    good = t.optimality_of(fit, known, "y").first()
    assert good.optimal and good.n == known.count() and good.terms == 9
    assert not t.optimality_of(fit, known.withColumn("y", F.col("y") + F.col("a")), "y").first().optimal


def test_no_rows_give_no_models(rows, spark, tmp_path):
    models = fitted(rows.limit(0), spark, tmp_path)
    assert models.count() == 0 and t.certificates(rows, models, "g", "y", XS).count() == 0
    assert t.predict_by_group(rows, models, "g", XS).where("prediction IS NULL").count() == 903
