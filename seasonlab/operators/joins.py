"""Joins that keep working when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 4
HOT_LEAST = 10_000.0  # rows of a key that one task takes easily
SEEN_IN = {"left": "left_only", "right": "right_only", "both": "both"}


def join_to_groups(df: DataFrame, groups: DataFrame, keys: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join rows to a table with one row per key.

    The rows of a key are spread over ``salts`` join keys and the group rows are
    repeated for each of them, so a hot key is never one task's work. The repeat
    also puts a shuffle directly under the join on both sides, the shape adaptive
    execution needs to cut a skewed partition further. Small group tables are
    broadcast by Spark from their measured size; there is no hint.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"not a join that keeps rows of the left side: {how}")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", salt).join(spread, [*keys, "_salt"], how).drop("_salt")


def full_join(left: DataFrame, right: DataFrame, keys: list[str], found: str | None = None, salts: int = 16) -> DataFrame:
    """Full outer join on null-safe keys that hot keys, null or not, do not hold up.

    Adaptive execution cannot split a full outer join. So rows per key are counted first,
    on both sides, combined in the map tasks, and the largest keys (four per task, of
    more than ``HOT_LEAST`` rows; any other key then has less than a quarter of a task's
    share) are brought to the driver: a bounded list. Without any, this is Spark's own
    join. A hot key's rows are spread over ``salts`` join keys on the side that has more
    of them and repeated for each on the other. A repeated row that meets nothing under
    one salt is dropped where its key is known to be on both sides. ``found`` names a
    column that tells on which side a row's key was found.
    """
    rest_l, rest_r = ([c for c in df.columns if c not in keys] for df in (left, right))
    names = [f"_k{i}" for i in range(len(keys))]
    as_names = [F.col(k).alias(n) for k, n in zip(keys, names)]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = left.select(*as_names, one.alias("_l"), none.alias("_r")).unionByName(right.select(*as_names, none.alias("_l"), one.alias("_r")))
    counts = sides.groupBy(*names).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r")).where(F.col("_l") + F.col("_r") > HOT_LEAST)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = counts.orderBy((F.col("_l") + F.col("_r")).desc()).limit(4 * tasks)
    found_hot = largest.collect()
    hot = left.sparkSession.createDataFrame(found_hot, largest.schema)

    def dealt(df: DataFrame, rest: list[str], mine: str, other: str) -> DataFrame:
        rows = df.select(*as_names, F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias(f"{mine}_row"))
        if not found_hot:
            return rows.withColumns({f"{mine}_copy": F.lit(False), "_salt": F.lit(0)})
        same = reduce(lambda a, b: a & b, [rows[n].eqNullSafe(hot[n]) for n in names])
        rows = rows.join(F.broadcast(hot), same, "left").select(*[rows[n] for n in names], f"{mine}_row", "_l", "_r")
        spread = F.col(mine).isNotNull() & ((F.col(mine) > F.col(other)) | ((F.col(mine) == F.col(other)) & F.lit(mine == "_l")))
        rows = rows.withColumn("_own", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))  # equal rows are spread too
        own = F.when(spread, F.array("_own"))
        every = F.when(F.col(mine).isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1)))
        both = (F.col("_l") > 0) & (F.col("_r") > 0)
        return rows.select(*names, f"{mine}_row", F.coalesce(both & ~spread, F.lit(False)).alias(f"{mine}_copy"), F.explode(F.coalesce(own, every, F.array(F.lit(0)))).alias("_salt"))

    a, b = dealt(left, rest_l, "_l", "_r"), dealt(right, rest_r, "_r", "_l")
    same = reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in [*names, *(["_salt"] if found_hot else [])]])
    joined = a.join(b, same, "full")
    alone = (F.col("_l_row").isNull() & F.col("_r_copy")) | (F.col("_r_row").isNull() & F.col("_l_copy"))
    joined = joined.where(~F.coalesce(alone, F.lit(False)))
    out = [F.when(F.col("_l_row").isNotNull(), a[n]).otherwise(b[n]).alias(k) for k, n in zip(keys, names)]
    out += [F.col("_l_row")[c].alias(c) for c in rest_l] + [F.col("_r_row")[c].alias(c) for c in rest_r]
    if found:
        side = F.when(F.col("_r_row").isNull(), SEEN_IN["left"]).when(F.col("_l_row").isNull(), SEEN_IN["right"])
        out.append(side.otherwise(SEEN_IN["both"]).alias(found))
    return joined.select(*out)


def join_indicator(left: DataFrame, right: DataFrame, keys: list[str], name: str = "found") -> DataFrame:
    """Full outer join that tells on which side each key was found; null keys meet each other."""
    return full_join(left, right, keys, name)


def prior_period(df: DataFrame, key: str, period: str, values: dict[str, str]) -> DataFrame:
    """Full outer join of each period with the one before it (period - 1, not the
    previous row). ``values`` maps a column to its name as a prior value."""
    prior = df.select(key, (F.col(period) + 1).alias(period), *[F.col(c).alias(n) for c, n in values.items()])
    return join_indicator(df, prior, [key, period], "found_prior")


def drop_bad_groups(df: DataFrame, keys: list[str], bad) -> DataFrame:
    """Drop every row of a group in which some row is bad."""
    return join_to_groups(df, df.where(bad).select(*keys).distinct(), keys, "left_anti")


def except_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of one table that the other one lacks."""
    return df.select(*keys).distinct().join(other.select(*keys).distinct(), keys, "left_anti")


def union_missing(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a missing column is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
