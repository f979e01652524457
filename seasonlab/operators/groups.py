"""Aggregates. All of them combine before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.operators.joins import join_to_groups


def _known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def group_sum(df: DataFrame, keys: list[str], values: dict[str, str], count: str | None = None) -> DataFrame:
    """Sums per group as numbers; an all-null group sums to 0 and null keys drop out."""
    aggs = [F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(n) for c, n in values.items()]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return df.where(_known(keys)).groupBy(*keys).agg(*aggs)


def add_total(df: DataFrame, keys: list[str], value: str, name: str = "total") -> DataFrame:
    """Group total on every row: an aggregate, combined before the shuffle, joined back."""
    return join_to_groups(df, df.groupBy(*keys).agg(F.sum(value).alias(name)), keys)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of ``value`` weighted by ``weight``; null when the weights add up to 0."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def share_percent(df: DataFrame, count: str, name: str = "pct") -> DataFrame:
    """Each row's share of the total in percent; the total is a scalar subquery."""
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, F.try_divide(F.col(count).cast("double"), total.cast("double")) * 100)


def blend_means(a: DataFrame, b: DataFrame, keys: list[str], col_a: str, col_b: str, name: str) -> DataFrame:
    """Average of two ratings per key, or the one present.

    Both lists are stacked and averaged per key in one aggregation; no pairs are
    formed when a key occurs several times on both sides.
    """
    stacked = a.select(*keys, F.col(col_a).alias("_a"), F.lit(None).cast("double").alias("_b")).unionByName(
        b.select(*keys, F.lit(None).cast("double").alias("_a"), F.col(col_b).alias("_b"))
    )
    means = stacked.where(_known(keys)).groupBy(*keys).agg(F.avg("_a").alias("_a"), F.avg("_b").alias("_b"))
    blend = (F.coalesce("_a", "_b") + F.coalesce("_b", "_a")) / 2
    return means.select(*keys, blend.alias(name))


def pivot_values(df: DataFrame, keys: list[str], pivot: str, values: list[str], categories: list[str], skip: tuple[str, ...] = (), extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per key with a column ``<value>_<category>`` for each declared category.

    Keys without any declared category drop out. ``extra`` aggregates, such as a
    total, run over all rows of the key in the same pass.
    """
    cells = [
        F.max(F.when(F.col(pivot) == c, F.col(v))).alias(f"{v}_{c}")
        for v in values
        for c in categories
        if f"{v}_{c}" not in skip
    ]
    more = [col.alias(n) for n, col in (extra or {}).items()]
    listed = F.col(pivot).isin(categories)
    if not more:
        return df.where(listed).groupBy(*keys).agg(*cells)
    out = df.groupBy(*keys).agg(*cells, *more, F.bool_or(listed).alias("_listed"))
    return out.where("_listed").drop("_listed")


def r2(df: DataFrame, y: str, pred: str, name: str = "r2") -> DataFrame:
    """Coefficient of determination over all rows, as one row."""
    error = F.sum((F.col(y) - F.col(pred)) * (F.col(y) - F.col(pred)))
    spread = F.var_pop(y) * F.count(y)
    known = F.col(y).isNotNull() & F.col(pred).isNotNull()
    return df.where(known).agg((1 - F.try_divide(error, spread)).alias(name))
