"""A path drill-down that does not read picks: a bitmap of leagues per (pick, choice).

Leagues are numbered once. What was chosen at a pick, by id and by position, is kept as the
set of the numbers of its leagues, in buckets of 32,768: as a bitmap where they are many,
as a list where they are few, so that a rare choice costs what it holds. A condition is
the union of its choices' sets, a path the intersection of its conditions, both bucket
by bucket; the answer is a few kilobytes per bucket, and a further condition starts from it.

Null leagues, picks and choices are in no set. Conditions with a predicate of their own
(``where``) are not in the index and are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.functions import Choice
from seasonlab.operators import number_rows

FEW = 256  # leagues of a bucket that are kept as a list


def number_leagues(picks: DataFrame) -> DataFrame:
    """(league, bucket, place): every league's number, from 1, as its bucket and its place there."""
    leagues = picks.where(F.col("league").isNotNull()).select("league").distinct().withColumn("_all", F.lit(1))
    numbered = number_rows(leagues, ["_all"], [("league", True)], "n")
    return numbered.select("league", F.bitmap_bucket_number("n").alias("bucket"), F.bitmap_bit_position("n").cast("int").alias("place"))


def build_index(picks: DataFrame, numbers: DataFrame) -> DataFrame:
    """(pick, kind, value, bucket, few, bits): the leagues of each choice at each pick.

    ``kind`` is ``id`` or ``pos``; of ``few`` (sorted places) and ``bits`` one is null.
    """
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in (("id", "player_id"), ("pos", "pos"))]
    placed = picks.where("pick IS NOT NULL").select("league", "pick", "player_id", "pos").join(numbers, "league")
    placed = placed.select("pick", F.inline(F.array(*kinds)), "bucket", "place").where("value IS NOT NULL")
    key = ["pick", "kind", "value", "bucket"]
    # dealt by key once, for both kinds of set: most keys are in one row, and nothing would combine before
    lists = placed.repartition(*key).groupBy(*key).agg(F.array_sort(F.collect_set("place")).alias("places"))
    few = F.size("places") < FEW
    rare = lists.where(few).select(*key, F.col("places").alias("few"), F.lit(None).cast("binary").alias("bits"))
    many = lists.where(~few).select(*key, F.explode("places").alias("place")).groupBy(*key)
    return rare.unionByName(many.agg(F.bitmap_construct_agg("place").alias("bits")).withColumn("few", F.lit(None).cast("array<int>")))


def _meets(index: DataFrame, condition: Choice):
    if condition.where or not (condition.ids or condition.positions):
        raise ValueError(f"not a condition that the index can answer: {condition}")
    options = []
    if condition.ids:
        options.append((F.col("kind") == "id") & F.col("value").isin([str(i) for i in dict.fromkeys(condition.ids)]))
    if condition.positions:
        options.append((F.col("kind") == "pos") & F.col("value").isin(list(dict.fromkeys(condition.positions))))
    return (F.col("pick") == condition.pick) & reduce(lambda a, b: a | b, options)


def follow(index: DataFrame, conditions: Sequence[Choice], within: DataFrame | None = None) -> DataFrame:
    """(bucket, bits): leagues that meet every condition, of those in ``within`` if given.

    Reads the index's rows of the conditions and nothing else. ``within`` is the answer to
    an earlier question, or several united by :func:`either`.
    """
    if not conditions:
        raise ValueError("a path has one condition at least")
    parts = []
    for i, condition in enumerate(conditions):
        rows = index.where(_meets(index, condition))
        listed = rows.select("bucket", F.explode("few").alias("place")).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
        parts.append(either(listed, rows.where("bits IS NOT NULL").select("bucket", "bits")).withColumn("c", F.lit(i)))
    if within is not None:
        parts.append(within.select("bucket", "bits").withColumn("c", F.lit(len(conditions))))
    met = reduce(DataFrame.unionByName, parts).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return met.where((F.col("n") == len(parts)) & (F.bitmap_count("bits") > 0)).select("bucket", "bits")


def either(*answers: DataFrame) -> DataFrame:
    """(bucket, bits): leagues in any of the answers."""
    return reduce(DataFrame.unionByName, answers).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_leagues(answer: DataFrame) -> DataFrame:
    """How many leagues an answer holds, one row."""
    return answer.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def leagues_of(answer: DataFrame, numbers: DataFrame) -> DataFrame:
    """The leagues of an answer: numbers whose bit is set."""
    met = numbers.join(answer, "bucket")
    byte = "CAST(conv(hex(substring(bits, CAST(place div 8 + 1 AS INT), 1)), 16, 10) AS INT)"
    return met.where(F.expr(f"(shiftright({byte}, place % 8) & 1) = 1")).select("league")
