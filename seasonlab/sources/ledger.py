"""What a store of numbered pages lacks, and fetching only that.

A source hands out rows by offset; a store holds the offsets it has got. Missing offsets
are told as ranges: gaps and islands over the stored offsets, cut into blocks so that no
task sorts all offsets of one key. Inside a block the gaps are worked out on one array of
bounded size; blocks without any row come out of the expected range alone; ranges that
touch across blocks are put together, which sorts ranges, not offsets.

Null keys and null offsets are no offsets; repeated ones count once; offsets outside the
expected range are left alone. An empty store lacks everything, an empty expectation
nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096  # offsets that one array may hold


def _block(offset: Column, block: int) -> Column:
    return F.floor(offset / F.lit(block)).cast("long")


def missing_ranges(stored: DataFrame, expected: DataFrame, keys: list[str], offset: str, block: int = BLOCK) -> DataFrame:
    """(keys, start, end) of the offsets that are expected and not stored, as few ranges as can be.

    ``expected`` has a row per key with the ``first`` and ``last`` offset of its source.
    """
    limits = expected.where(F.col("first") <= F.col("last")).groupBy(*keys).agg(F.min("first").cast("long").alias("_first"), F.max("last").cast("long").alias("_last"))
    blocks = limits.withColumn("_block", F.explode(F.sequence(_block(F.col("_first"), block), _block(F.col("_last"), block))))
    at = F.col(offset).cast("long")
    have = stored.where(at.isNotNull()).groupBy(*keys, _block(at, block).alias("_block")).agg(F.collect_set(at).alias("_have"))
    rows = blocks.join(have, [*keys, "_block"], "left")
    low = F.greatest(F.col("_first"), F.col("_block") * block)
    high = F.least(F.col("_last"), F.col("_block") * block + block - 1)
    inside = F.array_sort(F.filter(F.coalesce("_have", F.array().cast("array<bigint>")), lambda x: (x >= low) & (x <= high)))
    fence = F.concat(F.array(low - 1), inside, F.array(high + 1))
    ends = F.slice(F.col("_fence"), F.lit(2), F.size("_fence") - 1)
    steps = F.zip_with(F.slice(F.col("_fence"), F.lit(1), F.size("_fence") - 1), ends, lambda a, b: F.struct((a + 1).alias("start"), (b - 1).alias("end")))
    gaps = rows.withColumn("_fence", fence).select(*keys, F.inline(F.filter(steps, lambda s: s["start"] <= s["end"])))

    order = Window.partitionBy(*keys).orderBy("start")
    new = F.coalesce(F.col("start") > F.lag("end").over(order) + 1, F.lit(True))
    marked = gaps.withColumn("_new", new.cast("long"))
    islands = marked.withColumn("_island", F.sum("_new").over(order))
    return islands.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def rows_in_ranges(source: DataFrame, ranges: DataFrame, keys: list[str], offset: str, block: int = BLOCK) -> DataFrame:
    """Rows of a source whose offset lies in a range: joined by block, then compared.

    A range is listed once for each block it touches, so a long range is no product.
    """
    touched = ranges.withColumn("_block", F.explode(F.sequence(_block(F.col("start"), block), _block(F.col("end"), block))))
    rows = source.withColumn("_block", _block(F.col(offset).cast("long"), block))
    inside = (F.col(offset) >= F.col("start")) & (F.col(offset) <= F.col("end"))
    return rows.join(touched, [*keys, "_block"]).where(inside).select(*[F.col(f"`{c}`") for c in source.columns])


def complete(stored: DataFrame, expected: DataFrame, keys: list[str], offset: str, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that complete a store, fetched for its missing ranges only.

    ``fetch`` gets the ranges and returns rows with the store's columns; it may fail to bring
    some, which the next run asks for again.
    """
    return fetch(missing_ranges(stored, expected, keys, offset)).select(*[F.col(f"`{c}`") for c in stored.columns])
