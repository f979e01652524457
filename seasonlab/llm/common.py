"""Small helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.session import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whatever executor is lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made of it that no column has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def longs(values: list[int]) -> Column:
    """An array literal; made from one string so that the plan stays short."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def last_at_most(size: int, fits) -> Column:
    """How many leading entries of a sorted list fit, by binary search.

    ``fits(i)`` says whether entry ``i`` (a column, from 0) is not above the row's key.
    """
    steps, step = [], 1
    while step <= size:
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when((at + s <= size) & fits(F.least(at + s, F.lit(size)) - 1), at + s).otherwise(at),
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 2 mod 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
