"""Checks, each a DataFrame of what is wrong; an empty one means the data passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_same_columns(frames: dict[object, DataFrame]) -> bool:
    """True when all frames have the same columns in the same order (metadata only)."""
    shapes = {tuple(f.columns) for f in frames.values()}
    return len(shapes) <= 1


def short_span_keys(df: DataFrame, key: str, period: str, span: int, allowed: list | None = None) -> DataFrame:
    """Keys seen over fewer than ``span`` periods that are not on the allowed list."""
    known = df.where(F.col(key).isNotNull())
    if allowed:
        known = known.where(~F.col(key).isin(allowed))
    ends = known.groupBy(key).agg(F.min(period).alias("first"), F.max(period).alias("last"))
    return ends.where(F.col("last") - F.col("first") < span)


def fd_violations(df: DataFrame, key: str, dependent: str) -> DataFrame:
    """Keys with more than one value of a column that should depend on them."""
    ends = df.groupBy(key).agg(F.min(dependent).alias("low"), F.max(dependent).alias("high"))
    return ends.where(F.col("low") != F.col("high"))


def count_violations(df: DataFrame, keys: list[str], expected: int) -> DataFrame:
    """Groups that do not have exactly the expected number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != expected)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of nulls per column, as one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (columns or df.columns)])


def one_hot_violations(df: DataFrame, dummies: list[str]) -> DataFrame:
    """Rows that are not in exactly one of the dummy columns."""
    return df.where(reduce(lambda a, b: a + b, [F.col(c) for c in dummies]) != 1)
