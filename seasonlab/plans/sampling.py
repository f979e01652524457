"""Weighted orders, replacement levels and group-aware splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.functions import amount, pick_owner, round_of_pick, uniform_from_hash
from seasonlab.operators import join_to_groups, top_n

# Fixed value: a rating is turned around as (last listed rating + 1) - rating.
RATING_TOP = 301.0


def softmax_group(df: DataFrame, keys: list[str], rating: str, temperature: float, name: str = "probability") -> DataFrame:
    """Softmax of the turned-around rating within a group, at any temperature above 0.

    A group's weights are added up as (whole part of the exponent, sum of what is left of
    the exponentials): parts of one exponent add up, combined before the shuffle, and a
    group's parts meet scaled by its largest exponent, so nothing overflows and the sum is
    at least one half. One pass over the rows and one join; not a window: a group may be a
    large share of the table. A null rating has a null probability and no weight.
    """
    if not temperature > 0:
        raise ValueError(f"a temperature must be above 0, not {temperature}")
    x = (F.lit(RATING_TOP) - F.col(rating).cast("double")) / F.lit(float(temperature))
    rows = df.withColumn("_x", x)
    parts = rows.where(F.col("_x").isNotNull()).groupBy(*keys, F.rint("_x").alias("_whole")).agg(F.sum(F.exp(F.col("_x") - F.rint("_x"))).alias("_part"))
    tops = parts.groupBy(*keys).agg(F.max("_whole").alias("_top"))
    scaled = join_to_groups(parts, tops, keys).withColumn("_share", F.col("_part") * F.exp(F.col("_whole") - F.col("_top")))
    sums = scaled.groupBy(*keys).agg(F.first("_top").alias("_top"), F.sum("_share").alias("_total"))
    return join_to_groups(rows, sums, keys).withColumn(name, F.exp(F.col("_x") - F.col("_top")) / F.col("_total")).drop("_x", "_top", "_total")


def sampled_order(pool: DataFrame, keys: list[str], key: str, rating: str, temperature: float, samples: int, picks: int, teams: int = 10, seed: int = 0) -> DataFrame:
    """Repeated draws without replacement, chance by softmax, as recorded picks.

    Drawing one by one from a softmax equals sorting by x / T plus Gumbel noise. The
    noise is a function of (seed, sample, group, id), so a re-run gives the same draft.
    Rules on who may still be drawn (roster limits) are not part of this.
    """
    x = (F.lit(RATING_TOP) - F.col(rating)) / F.lit(float(temperature))
    drawn = pool.where(F.col(rating).isNotNull()).withColumn("sample", F.explode(F.sequence(F.lit(1), F.lit(samples))))
    u = uniform_from_hash(F.lit(seed), F.col("sample"), *[F.col(k) for k in keys], F.col(key))
    drawn = drawn.withColumn("draw", x - F.log(-F.log(u)))
    first = top_n(drawn, [*keys, "sample"], [("draw", False), (key, True)], picks, "pick")
    return first.withColumns({"round": round_of_pick("pick", teams), "team": pick_owner("pick", teams)})


def replacement_level(pool: DataFrame, keys: list[str], pos: str, order: list[tuple[str, bool]], values: list[str], wait: int, top: int = 3) -> DataFrame:
    """Value of each candidate over who would still be there after ``wait`` picks.

    The base of a position is the mean of its ``top`` best once the first ``wait`` of
    the whole pool are gone. Those are all within the first ``wait + top`` of their
    position, so only that many per position are ranked across positions.
    """
    near = top_n(pool, [*keys, pos], order, wait + top, "_near").drop("_near")
    pool_order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() if asc else F.col(c).desc() for c, asc in order])
    left = near.withColumn("_place", F.row_number().over(pool_order)).where(F.col("_place") > wait)
    still = top_n(left, [*keys, pos], order, top)
    means = [(F.sum(amount(v)).cast("double") / F.count(v)).alias(f"{v}_base") for v in values]
    bases = still.groupBy(*keys, pos).agg(*means)
    out = join_to_groups(pool, bases, [*keys, pos])
    return out.withColumns({f"{v}_diff": F.col(v).cast("double") - F.col(f"{v}_base") for v in values})


def bucket_of(columns: list[str], buckets: int = 100) -> Column:
    """Bucket of a row fixed by its identifying columns."""
    text = reduce(lambda a, b: F.concat(a, b), [F.concat(F.lit("_"), F.col(c).cast("string")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def split_by_group(df: DataFrame, identifiers: list[str], train_percent: int = 80, name: str = "part") -> DataFrame:
    """Mark rows train or test, all rows of an identifier on one side."""
    return df.withColumn(name, F.when(bucket_of(identifiers) < train_percent, "train").otherwise("test"))


def train_test(df: DataFrame, identifiers: list[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    marked = split_by_group(df, identifiers, train_percent, "_part")
    return (
        marked.where(F.col("_part") == "train").drop("_part"),
        marked.where(F.col("_part") == "test").drop("_part"),
    )
