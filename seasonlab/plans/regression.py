"""Regressions on feature tables with ``pyspark.ml``."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, MaxAbsScaler, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.functions import amount
from seasonlab.operators import r2
from seasonlab.plans.sampling import train_test

FOLDS = 5
ALPHAS = 100
ALPHA_SPAN = 1e-3  # smallest penalty tried, as a share of the largest useful one
DRIVER_TERMS = 1024  # features whose sums of products the driver takes; those of more stay in tasks
LINES = 256  # lines of a sum of products that a task hands on at once

LOG_SCHEMA = "Name string, Description string, Model string, TimeToFinish double, TrainR2 double, TestR2 double, Position string"


@dataclass(frozen=True)
class Fit:
    """A fitted pipeline with its quality."""

    model: PipelineModel
    train_r2: float
    test_r2: float
    seconds: float
    alpha: float


def feature_stages(xs: Sequence[str], degree: int) -> list:
    """Mean for missing values, all products up to a degree, scaling by largest value."""
    filled = [f"_filled_{x}" for x in xs]
    stages = [
        Imputer(inputCols=list(xs), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="_x"),
    ]
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol="_x", outputCol="_poly"))
    last = "_poly" if degree > 1 else "_x"
    return [*stages, MaxAbsScaler(inputCol=last, outputCol="_features")]


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def moments(prepared: DataFrame, y: str, folds: int) -> list[np.ndarray]:
    """Per fold, the sums of products of (1, outcome, features).

    One job per fold over its own rows, so that every row is added up once. What comes back has one row and column per feature, whatever the
    number of rows.
    """
    wide = VectorAssembler(inputCols=["_one", y, "_features"], outputCol="_v").transform(
        prepared.withColumn("_one", F.lit(1.0))
    )
    wide = MLUtils.convertVectorColumnsFromML(wide.select("_fold", "_v"), "_v")

    def products(fold: int) -> np.ndarray:
        rows = wide.where(F.col("_fold") == fold).select("_v")
        return RowMatrix(rows).computeGramianMatrix().toArray()

    with ThreadPoolExecutor(folds) as pool:
        return list(pool.map(products, range(folds)))


def centred(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covariance of the features, their covariance with the outcome, and the means."""
    n = sums[0, 0]
    means = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(means, means)
    return cov[1:, 1:], cov[1:, 0], means


def shrink(cov: np.ndarray, by_y: np.ndarray, alpha: float, w: np.ndarray, tolerance: float = 1e-6, most: int = 20_000) -> np.ndarray:
    """Weights for one penalty from the feature covariances, starting at ``w``.

    The weights in use, with their signs, solve a linear system; one that would change
    its sign leaves, then the feature whose pull exceeds the penalty most joins in.
    Raises if that has not settled after ``most`` steps.
    """
    usable = np.diag(cov) > 1e-12
    limit = alpha * (1 + tolerance) + 1e-12 * np.abs(by_y).max(initial=0.0)
    w, signs = w.copy(), np.sign(w)
    active = list(np.flatnonzero(w))
    for _ in range(most):
        if active:
            inner = cov[np.ix_(active, active)]
            inner = inner + np.diag(1e-10 * np.diag(inner))
            new = np.linalg.solve(inner, by_y[active] - alpha * signs[active])
            old = w[active]
            crossing = new * signs[active] < 0
            if crossing.any():
                share = old / np.where(old == new, 1.0, old - new)
                share[~crossing] = np.inf
                first = int(np.argmin(share))
                w[active] = old + max(0.0, float(share[first])) * (new - old)
                gone = active.pop(first)
                w[gone] = signs[gone] = 0.0
                continue
            w[active] = new
        pull = by_y - cov[:, active] @ w[active]
        over = np.where(usable, np.abs(pull), 0.0)
        over[active] = 0.0
        joining = int(np.argmax(over))
        if over[joining] <= limit:
            return w
        active.append(joining)
        signs[joining] = np.sign(pull[joining])
    raise RuntimeError(f"weights for penalty {alpha} have not settled after {most} steps")


def squared_error(sums: np.ndarray, w: np.ndarray, intercept: float) -> float:
    """Mean squared error of a linear model on the rows behind the sums."""
    v = np.concatenate([[-intercept, 1.0], -w])
    return float(v @ sums @ v) / sums[0, 0]


def deal_rows(rows: DataFrame, n: int, terms: int, folds: int) -> tuple[DataFrame, int]:
    """Rows with a fold (``_fold``), a fold in as few tasks as its rows, ``n`` for all folds,
    are worth, and that number: a task hands on sums with the size of the feature count squared."""
    parts = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, n // (folds * 8 * terms)))
    return rows.repartition(folds * parts, "_fold", F.pmod(F.monotonically_increasing_id(), F.lit(parts))), parts


def moment_lines(prepared: DataFrame, y: str, spread: bool = True) -> DataFrame:
    """(fold, i, sums): line i, up to its diagonal, of a fold's sums of products, as
    :func:`moments` has them, added up in tasks. A fold without rows has no lines. Only
    folds ``spread`` over several tasks need a shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, outcomes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "y"))
            terms = batch.column("terms").flatten().to_numpy().reshape(len(folds), -1)
            for fold in np.unique(folds):
                at = folds == fold
                v = np.column_stack([np.ones(at.sum()), outcomes[at], terms[at]])
                held[fold] = held.get(fold, 0.0) + v.T @ v
        for fold, sums in held.items():
            for first in range(0, len(sums), LINES):
                at = np.arange(first, min(first + LINES, len(sums)), dtype=np.int32)
                starts = np.concatenate([[0], np.cumsum(at + 1)]).astype(np.int32)
                cells = np.concatenate([sums[i, : i + 1] for i in at])
                lines = [pa.array(np.full(len(at), fold, dtype=np.int32)), pa.array(at), pa.ListArray.from_arrays(pa.array(starts), pa.array(cells))]
                yield pa.RecordBatch.from_arrays(lines, names=["fold", "i", "sums"])

    rows = prepared.select(F.col("_fold").cast("int").alias("fold"), F.col(y).cast("double").alias("y"), vector_to_array("_features").alias("terms"))
    parts = rows.mapInArrow(partial, "fold int, i int, sums array<double>")
    if not spread:
        return parts
    added = parts.groupBy("fold", "i").agg(Summarizer.metrics("sum").summary(array_to_vector("sums")).alias("s"))
    return added.select("fold", "i", vector_to_array("s.sum").alias("sums"))


def whole_sums(lines: pd.DataFrame) -> np.ndarray:
    """A fold's sums of products from its lines."""
    lines = lines.sort_values("i")["sums"].to_list()
    sums = np.zeros((len(lines), len(lines)))
    for i, line in enumerate(lines):
        sums[i, : i + 1] = sums[: i + 1, i] = line
    return sums


def choose_wide_penalty(prepared: DataFrame, y: str, count: int = ALPHAS, spread: bool = True) -> float:
    """:func:`choose_penalty` for many features: one task walks the penalties of all folds,
    on sums whose size does not depend on the number of rows. The driver gets the penalty."""

    def walk(lines: pd.DataFrame) -> pd.DataFrame:
        by_fold = [whole_sums(part) for _, part in lines.groupby("fold")]
        return pd.DataFrame({"alpha": [lowest_error(by_fold, count)]})

    found = moment_lines(prepared, y, spread).groupBy().applyInPandas(walk, "alpha double").first()
    return found.alpha if found else 0.0


def choose_penalty(prepared: DataFrame, y: str, folds: int = FOLDS, count: int = ALPHAS) -> float:
    """Penalty with the lowest cross-validated error on a falling log grid.

    Sums of a training part are the total less the held-out fold, so all folds and all
    penalties come out of the sums of products; a fit by Spark for each of them would
    read the rows five hundred times.
    """
    return lowest_error([m for m in moments(prepared, y, folds) if m[0, 0] > 0], count)


def lowest_error(by_fold: list[np.ndarray], count: int) -> float:
    """Penalty with the lowest cross-validated error, from each fold's sums of products."""
    total = np.sum(by_fold, axis=0)
    means = total[0, 1:] / total[0, 0]
    top = np.abs(total[1, 2:] / total[0, 0] - means[0] * means[1:]).max(initial=0.0)
    size_of_y = np.sqrt(total[1, 1] / total[0, 0])
    if top <= 1e-12 * size_of_y or len(by_fold) < 2:
        return 0.0
    grid = top * np.logspace(0, np.log10(ALPHA_SPAN), count)
    errors = np.zeros(count)
    for held in by_fold:
        cov, by_y, means = centred(total - held)
        w = np.zeros(len(by_y))
        for k, alpha in enumerate(grid):
            w = shrink(cov, by_y, alpha, w)
            errors[k] += squared_error(held, w, means[0] - means[1:] @ w)
    return float(grid[errors.argmin()])


def fit_poly_lasso(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], degree: int = 2, folds: int = FOLDS, alphas: int = ALPHAS, prediction: str = "prediction") -> Fit:
    """L1 regression on polynomial features, penalty chosen by cross-validation.

    Folds are set by a hash of the row, so a re-run makes the same choice. The final
    fit uses the normal equations, again one pass over the rows. Only the given features
    are kept; their products are made anew in every pass, since those of a partition would
    be many times its size.
    """
    started = time.monotonic()
    train = numeric(train, [*xs, y]).where(F.col(y).isNotNull()).select(*xs, y).persist()
    test = numeric(test, [*xs, y]).select(*xs, y)
    prepare = Pipeline(stages=feature_stages(xs, degree)).fit(train)
    terms = prepare.stages[-1].maxAbs.size
    wide = terms > DRIVER_TERMS
    rows = train.withColumn("_fold", F.pmod(F.xxhash64(*xs, y), F.lit(folds)).cast("int"))
    rows, parts = deal_rows(rows, train.count(), terms, folds) if wide else (rows, 0)
    prepared = prepare.transform(rows).select("_features", y, "_fold")
    try:
        alpha = choose_wide_penalty(prepared, y, alphas, parts > 1) if wide else choose_penalty(prepared, y, folds, alphas)
        best = LinearRegression(
            featuresCol="_features",
            labelCol=y,
            predictionCol=prediction,
            regParam=alpha,
            elasticNetParam=1.0,
            standardization=False,
            solver="normal",
            maxIter=1000,
        ).fit(prepared)
        model = PipelineModel(stages=[*prepare.stages, best])
        seconds = time.monotonic() - started
        return Fit(model, score(model, train, y, prediction), score(model, test, y, prediction), seconds, alpha)
    finally:
        train.unpersist()


def predict(model: PipelineModel, df: DataFrame, xs: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Add the prediction and nothing else."""
    keep = [c for c in df.columns if c != prediction]
    out = model.transform(numeric(df.drop(prediction), xs))
    return out.select(*keep, prediction)


def score(model: PipelineModel, df: DataFrame, y: str, prediction: str = "prediction") -> float | None:
    """R² of a model on a table; None when it cannot be told."""
    xs = model.stages[0].getInputCols()
    rows = model.transform(numeric(df.drop(prediction), [*xs, y]))
    return r2(rows, y, prediction).first()["r2"]


def fit_split(df: DataFrame, y: str, xs: Sequence[str], identifiers: list[str], degree: int = 2, **options) -> Fit:
    """Fit on 80 percent of the identifiers and test on the others."""
    return fit_poly_lasso(*train_test(df, identifiers), y, xs, degree, **options)


def two_stage_fit(train: DataFrame, everything: DataFrame, y: str, xs: Sequence[str], rating: str, identifiers: list[str], degrees: tuple[int, int] = (3, 2), undrafted_rating: float = 350, **options) -> tuple[DataFrame, Fit, Fit]:
    """Predict the outcome, then its squared error with the prediction as a feature.

    Models are fitted on ``train``; all rows of ``everything`` listed above the
    undrafted rating are scored: columns pred, var, var2, var_pred.
    """
    mean_fit = fit_split(train, y, xs, identifiers, degrees[0], **options)

    def scored(df: DataFrame) -> DataFrame:
        out = predict(mean_fit.model, df, xs).withColumnRenamed("prediction", "pred")
        out = out.withColumn("var", F.col(y).cast("double") - F.col("pred"))
        return out.withColumn("var2", F.col("var") * F.col("var"))

    wider = [*xs, "pred"]
    error_fit = fit_split(scored(train), "var2", wider, identifiers, degrees[1], **options)
    out = predict(error_fit.model, scored(everything), wider).withColumnRenamed("prediction", "var_pred")
    return out.where(F.col(rating) < undrafted_rating), mean_fit, error_fit


def log_row(spark: SparkSession, name: str, description: str, degree: int, fit: Fit, position: str | None = None) -> DataFrame:
    """One line of the results log."""
    row = (name, description, f"lasso_poly{degree}", fit.seconds, fit.train_r2, fit.test_r2, position)
    return spark.createDataFrame([row], LOG_SCHEMA)


def log_of(found: DataFrame, name: str, description: str, degree: int) -> DataFrame:
    """Lines of the results log from a table of qualities per position."""
    told = {"Name": F.lit(name), "Description": F.lit(description), "Model": F.lit(f"lasso_poly{degree}"), "TimeToFinish": F.lit(None).cast("double"), "Position": F.col("pos")}
    rows = found.withColumns(told)
    return rows.select("Name", "Description", "Model", "TimeToFinish", "TrainR2", "TestR2", "Position")


def degree_sweep(spark: SparkSession, sets: dict[str, tuple[str, DataFrame, Sequence[str], Sequence[int]]], y: str, identifiers: list[str], **options) -> tuple[DataFrame, dict[tuple[str, int], Fit]]:
    """Fit every feature set (description, rows, features, degrees) at every degree."""
    fits, rows = {}, []
    for name, (description, df, xs, degrees) in sets.items():
        df = df.persist()
        try:
            for degree in degrees:
                fit = fit_split(df, y, xs, identifiers, degree, **options)
                fits[name, degree] = fit
                rows.append(log_row(spark, name, description, degree, fit))
        finally:
            df.unpersist()
    return reduce(DataFrame.unionByName, rows), fits


def group_features(position: str, two_starters: Sequence[str]) -> list[str]:
    """Features of a position's model; the second member counts where two start."""
    base = ["a_pred_points", "a_std_error", "num_others", "avg_pred_points_other", "avg_std_error_other"]
    return base + (["b_pred_points", "b_std_error"] if position in two_starters else [])


def models_by_group(df: DataFrame, y: str, positions: Sequence[str], two_starters: Sequence[str], identifiers: list[str], degree: int = 1, pos: str = "pos", **options) -> dict[str, Fit]:
    """One model per position, all split along the same identifiers."""
    train, test = train_test(df, identifiers)
    fits = {}
    for p in positions:
        here = F.col(pos) == p
        fits[p] = fit_poly_lasso(train.where(here), test.where(here), y, group_features(p, two_starters), degree, **options)
    return fits


def position_sweep(spark: SparkSession, df: DataFrame, y: str, positions: Sequence[str], two_starters: Sequence[str], identifiers: list[str], degrees: Sequence[int] = (1, 2, 3), **options) -> tuple[DataFrame, dict[int, dict[str, Fit]]]:
    """Models of every position at every degree, as a results log.

    Each degree closes with a row for the test teams' sums over all positions.
    """
    name, what = "ByPositionLinear", "a regression on each position"
    df = df.persist()
    try:
        rows, fits = [], {}
        test = train_test(df, identifiers)[1]
        for degree in degrees:
            fits[degree] = models_by_group(df, y, positions, two_starters, identifiers, degree, **options)
            rows += [log_row(spark, name, what, degree, fit, p) for p, fit in fits[degree].items()]
            r2_of_sums = overall_r2(test, {p: f.model for p, f in fits[degree].items()}, y, identifiers).first()["r2"]
            total = spark.createDataFrame([(name, "sums of the positions", f"lasso_poly{degree}", None, None, r2_of_sums, "Aggregated")], LOG_SCHEMA)
            rows.append(total)
        return reduce(DataFrame.unionByName, rows), fits
    finally:
        df.unpersist()


def group_predictor(models: dict[str, PipelineModel], pos: str = "pos") -> Callable[[DataFrame], DataFrame]:
    """A function that adds each row's prediction by its position's model."""

    def apply(df: DataFrame) -> DataFrame:
        parts = []
        for p, model in models.items():
            parts.append(predict(model, df.where(F.col(pos) == p), model.stages[0].getInputCols()))
        return reduce(DataFrame.unionByName, parts)

    return apply


def overall_r2(df: DataFrame, models: dict[str, PipelineModel], y: str, identifiers: list[str]) -> DataFrame:
    """R² of predictions added up per identifier."""
    scored = group_predictor(models)(df)
    sums = scored.groupBy(*identifiers).agg(
        F.sum(amount(y)).cast("double").alias("y"), F.sum(amount("prediction")).cast("double").alias("p")
    )
    return r2(sums, "y", "p")


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    for key, model in models.items():
        model.write().overwrite().save(f"{folder}/pos={key}")


def load_models(folder: str, keys: Sequence[str]) -> dict[str, PipelineModel]:
    return {k: PipelineModel.load(f"{folder}/pos={k}") for k in keys}
