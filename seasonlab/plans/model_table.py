"""Penalised fits of all groups at once, and models as rows of a table.

The rows are read three times, whatever the number of groups, folds and penalties: for
the means that stand in for missing values, for the scales of the polynomial terms, and
for the sums of products per (group, fold). Those sums are added up in the map tasks and
combined by Spark; a task per group then walks its penalties over them. The driver gets
nothing but plans.

A fitted model is a row: group, means, scales, weights, intercept, penalty. Predicting is
a join of rows to their group's model and a dot product, one scan for all groups. Whether
a model is the optimum of its penalty is told by one aggregate per term
(:func:`certificates`), without trusting the solver.

Nulls and NaN in a feature take the group's mean over the fitted rows, 0 if it has none.
Rows with a null outcome or key are not fitted; a row without a model gets a null
prediction. A term without spread has weight 0. A group with one fold of rows, or whose
terms tell nothing of the outcome, is fitted without penalty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.operators import join_to_groups
from seasonlab.plans.regression import ALPHA_SPAN, ALPHAS, FOLDS, Fit, centred, numeric, shrink, squared_error
from seasonlab.plans.sampling import bucket_of

HELD_MB = 64  # sums of products that a task holds before it hands them on
ROUNDING = 1e-9  # of the outcome's size, allowed to a certificate
SAME_ERROR = 1e-7  # cross-validated errors this close count as equal; the larger penalty wins

MODEL = "n long, degree int, penalty double, top_penalty double, intercept double, weights array<double>"


def fold_of(identifiers: list[str], folds: int = FOLDS) -> Column:
    """Fold fixed by the identifying columns, independent of the train and test buckets."""
    return F.pmod(F.floor(bucket_of(identifiers, 100 * folds) / 100), F.lit(folds)).cast("int")


def _inputs(xs: Sequence[str], unused: dict[str, Sequence[str]], key: str) -> Column:
    """Features as an array; NaN is null, and so is what a group does not use."""
    cells = []
    for x in xs:
        without = [k for k, names in unused.items() if x in names]
        cell = F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double"))
        cells.append(F.when(F.col(key).isin(without), F.lit(None)).otherwise(cell) if without else cell)
    return F.array(*cells)


def _filled(inputs: Column, means: Column) -> Column:
    return F.zip_with(inputs, means, lambda x, m: F.coalesce(x, m, F.lit(0.0)))


def _terms(df: DataFrame, filled: Column, degree: int, name: str) -> DataFrame:
    """All products of features up to a degree, as an array."""
    df = df.withColumn("_vector", array_to_vector(filled))
    if degree > 1:
        df = PolynomialExpansion(degree=degree, inputCol="_vector", outputCol="_expanded").transform(df)
        return df.withColumn(name, vector_to_array("_expanded")).drop("_vector", "_expanded")
    return df.withColumn(name, vector_to_array("_vector")).drop("_vector")


def _moments(prepared: DataFrame, size: int) -> DataFrame:
    """(key, fold, i, sums): row i of the sums of products of (1, outcome, terms)."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pd.DataFrame:
            rows = [(k, fold, i, line.tolist()) for (k, fold), sums in held.items() for i, line in enumerate(sums)]
            return pd.DataFrame(rows, columns=["key", "fold", "i", "sums"])

        for batch in batches:
            for at, part in batch.groupby(["key", "fold"]):
                v = np.column_stack([np.ones(len(part)), part["y"], np.stack(part["terms"].to_list())])
                held[at] = held.get(at, 0.0) + v.T @ v
            if len(held) * (size + 2) ** 2 * 8 > HELD_MB << 20:
                yield out()
                held.clear()
        if held:
            yield out()

    kind = prepared.schema["key"].dataType.simpleString()
    parts = prepared.mapInPandas(partial, f"key {kind}, fold int, i int, sums array<double>")
    added = parts.groupBy("key", "fold", "i").agg(Summarizer.metrics("sum").summary(array_to_vector("sums")).alias("s"))
    return added.select("key", "fold", "i", vector_to_array("s.sum").alias("sums"))


def best_fit(by_fold: list[np.ndarray], count: int, penalty: float | None = None) -> tuple[float, float, float, np.ndarray]:
    """(penalty, largest useful one, intercept, weights) from each fold's sums of products.

    The penalty is the largest of a falling log grid whose cross-validated error is the
    least, unless it is given.
    """
    total = np.sum(by_fold, axis=0)
    cov, by_y, means = centred(total)
    by_y = np.where(np.diag(cov) > 1e-12, by_y, 0.0)
    if np.abs(by_y).max(initial=0.0) <= 1e-12 * np.sqrt(total[1, 1] / total[0, 0]):
        by_y = np.zeros(len(by_y))  # what is left of a constant outcome are rounding errors
    top = float(np.abs(by_y).max(initial=0.0))
    if penalty is None:
        penalty = 0.0
        if top > 0 and len(by_fold) > 1:
            grid = top * np.logspace(0, np.log10(ALPHA_SPAN), count)
            errors = np.zeros(count)
            for held in by_fold:
                inner, inner_y, inner_means = centred(total - held)
                w = np.zeros(len(inner_y))
                for k, alpha in enumerate(grid):
                    w = shrink(inner, inner_y, alpha, w)
                    errors[k] += squared_error(held, w, inner_means[0] - inner_means[1:] @ w)
            penalty = float(grid[np.flatnonzero(errors <= errors.min() * (1 + SAME_ERROR))[0]])
    w = shrink(cov, by_y, penalty, np.zeros(len(by_y)))
    return penalty, top, float(means[0] - means[1:] @ w), w


def fit_models(rows: DataFrame, key: str, y: str, xs: Sequence[str], fold: Column, degree: int = 1, unused: dict[str, Sequence[str]] | None = None, alphas: int = ALPHAS, penalty: float | None = None) -> DataFrame:
    """One row per value of ``key``: its L1 regression on all products of the features.

    ``unused`` names features that some groups' models do without. ``fold`` deals rows to
    the parts of the cross-validation; a given ``penalty`` makes that unnecessary. The
    result is a plan: write it, and use the written table.
    """
    unused = unused or {}
    known = rows.where(F.col(y).isNotNull() & F.col(key).isNotNull())
    known = known.select(F.col(key).alias("key"), F.col(y).cast("double").alias("y"), fold.alias("fold"), _inputs(xs, unused, key).alias("x"))
    means = known.groupBy("key").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(xs))]).alias("means"))
    known = _terms(join_to_groups(known, means, ["key"]), _filled(F.col("x"), F.col("means")), degree, "terms").select("key", "y", "fold", "terms")
    spans = known.groupBy("key").agg(Summarizer.metrics("min", "max").summary(array_to_vector("terms")).alias("s"))
    largest = F.zip_with(vector_to_array("s.min"), vector_to_array("s.max"), lambda a, b: F.greatest(F.abs(a), F.abs(b)))
    scales = spans.select("key", F.transform(largest, lambda v: F.when(v > 0, v).otherwise(1.0)).alias("scales"))
    scaled = join_to_groups(known, scales, ["key"]).select("key", "fold", "y", F.zip_with("terms", "scales", lambda t, s: t / s).alias("terms"))

    def solve(cells: pd.DataFrame) -> pd.DataFrame:
        by_fold = [np.stack(part.sort_values("i")["sums"].to_list()) for _, part in cells.groupby("fold")]
        chosen, top, intercept, w = best_fit(by_fold, alphas, penalty)
        n = round(sum(m[0, 0] for m in by_fold))
        row = (cells["key"].iloc[0], n, degree, chosen, top, intercept, w.tolist())
        return pd.DataFrame([row], columns=["key", "n", "degree", "penalty", "top_penalty", "intercept", "weights"])

    kind = known.schema["key"].dataType.simpleString()
    size = comb(len(xs) + degree, degree) - 1
    solved = _moments(scaled, size).groupBy("key").applyInPandas(solve, f"key {kind}, {MODEL}")
    return solved.join(means, "key").join(scales, "key").withColumnRenamed("key", key)


def with_terms(rows: DataFrame, models: DataFrame, key: str, xs: Sequence[str], degree: int, unused: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows beside their group's model (``_model``), with scaled terms (``_terms``) and the
    prediction (``_pred``), all null where the group has no model."""
    model = models.select(F.col(key), F.struct("penalty", "intercept", "weights", "means", "scales").alias("_model"))
    out = join_to_groups(rows, model, [key])
    means = F.coalesce(F.col("_model.means"), F.array_repeat(F.lit(0.0), len(xs)))
    out = _terms(out, _filled(_inputs(xs, unused or {}, key), means), degree, "_terms")
    out = out.withColumn("_terms", F.zip_with("_terms", "_model.scales", lambda t, s: t / s))
    dot = F.aggregate(F.zip_with("_terms", "_model.weights", lambda t, w: t * w), F.lit(0.0), lambda a, b: a + b)
    return out.withColumn("_pred", F.col("_model.intercept") + dot)


def predict_by_group(rows: DataFrame, models: DataFrame, key: str, xs: Sequence[str], degree: int = 1, unused: dict[str, Sequence[str]] | None = None, name: str = "prediction") -> DataFrame:
    """Rows with their prediction, as last column, by their group's model; others stay as they are."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c != name]
    out = with_terms(rows.select(*kept), models, key, xs, degree, unused)
    return out.select(*kept, F.col("_pred").alias(name))


def optimality(terms: DataFrame, keys: list[str]) -> DataFrame:
    """How far weights are from the optimum of their penalty, per group.

    ``terms`` has, per row, ``_terms``, ``_y``, ``_resid`` (outcome less prediction),
    ``_weights`` and ``_penalty``. At the optimum of a penalty a, the mean of term times residual is a
    times the sign of a weight in use, and at most a in size for others; the mean
    residual is 0. Returns n, terms, used (weights that are not 0), pull (the
    largest size of those means), excess (by how much the conditions are missed at the
    utmost), bias (the mean residual), spread (the outcome's standard deviation) and size
    (its root mean square).
    """
    pulls = F.transform("_terms", lambda t: t * F.col("_resid"))
    found = terms.groupBy(*keys).agg(
        Summarizer.metrics("mean").summary(array_to_vector(pulls)).alias("s"),
        F.count(F.lit(1)).alias("n"),
        F.avg("_resid").alias("bias"),
        F.any_value("_weights").alias("w"),
        F.any_value("_penalty").alias("a"),
        F.stddev_pop("_y").alias("spread"),
        F.sqrt(F.avg(F.col("_y") * F.col("_y"))).alias("size"),
    )
    pull = vector_to_array("s.mean")
    missed = F.zip_with(pull, "w", lambda g, w: F.when(w == 0, F.greatest(F.abs(g) - F.col("a"), F.lit(0.0))).otherwise(F.abs(g - F.signum(w) * F.col("a"))))
    return found.select(
        *keys,
        "n",
        F.size("w").cast("long").alias("terms"),
        F.size(F.filter("w", lambda w: w != 0)).cast("long").alias("used"),
        F.array_max(F.transform(pull, lambda g: F.abs(g))).alias("pull"),
        F.array_max(missed).alias("excess"),
        "bias",
        "spread",
        "size",
    )


def certificates(rows: DataFrame, models: DataFrame, key: str, y: str, xs: Sequence[str], degree: int = 1, unused: dict[str, Sequence[str]] | None = None, tolerance: float = 1e-4) -> DataFrame:
    """Per group, whether its model is the optimum of its penalty on the rows it was fitted on.

    ``optimal`` allows ``tolerance`` of the largest useful penalty.
    """
    known = rows.where(F.col(y).isNotNull() & F.col(key).isNotNull())
    terms = with_terms(known, models, key, xs, degree, unused).where(F.col("_model").isNotNull())
    terms = terms.select(key, "_terms", F.col(y).cast("double").alias("_y"), (F.col(y).cast("double") - F.col("_pred")).alias("_resid"), F.col("_model.weights").alias("_weights"), F.col("_model.penalty").alias("_penalty"))
    found = optimality(terms, [key]).join(models.select(key, "top_penalty", "penalty"), key)
    return found.withColumn("optimal", F.greatest("excess", F.abs("bias")) <= tolerance * F.col("top_penalty") + ROUNDING * F.col("size"))


def optimality_of(fit: Fit, train: DataFrame, y: str, tolerance: float = 1e-4) -> DataFrame:
    """:func:`optimality` of a fitted pipeline on its training rows, as one row (none for
    no rows); ``optimal`` allows ``tolerance`` of the outcome's standard deviation."""
    xs, last = fit.model.stages[0].getInputCols(), fit.model.stages[-1]
    rows = numeric(train, [*xs, y]).where(F.col(y).isNotNull()).select(*xs, y)
    scored = fit.model.transform(rows).select(
        vector_to_array(last.getFeaturesCol()).alias("_terms"),
        (F.col(y) - F.col(last.getPredictionCol())).alias("_resid"),
        F.lit([float(w) for w in last.coefficients]).alias("_weights"),
        F.lit(fit.alpha).alias("_penalty"),
        F.col(y).alias("_y"),
    )
    found = optimality(scored, []).where("n > 0")
    return found.withColumn("optimal", F.greatest("excess", F.abs("bias")) <= tolerance * F.col("spread") + ROUNDING * F.col("size"))
