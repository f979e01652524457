"""Exact copies by a split of frequent and rare digests, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import stored

SLICES = 64


def frequent_digests(digests: DataFrame, digest: str = "digest", heavy: int = 16_384, counters: int = 1_024) -> DataFrame:
    """At most ``heavy`` 64-bit prints of digests that occur often.

    Each slice of the prints keeps ``counters`` Misra-Gries counters (Spark's
    ``approx_top_k`` is such a sketch), first per task and then merged, so that a
    print on more than about 1 / ``counters`` of its slice cannot be missed.
    """
    prints = digests.select(F.xxhash64(digest).alias("print"))
    slices = prints.groupBy(F.pmod("print", F.lit(SLICES)).alias("slice")).agg(
        F.expr(f"approx_top_k(print, {heavy // SLICES}, {counters})").alias("top")
    )
    each = slices.select(F.explode("top").alias("t")).select(F.col("t.item").alias("print"), F.col("t.count").alias("n"))
    return each.where("n > 1").select("print")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 16_384) -> DataFrame:
    """Every row with the row that stays of its group of equal texts.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the row with
    the largest id stays; of rows that also share the id, exactly one. A null text is
    empty, a null id is smaller than any other. Texts are compared by SHA-256.

    Digests are written once. The winners of frequent digests are verified on the
    full digest, number at most ``heavy`` and are broadcast, so that copies of them are
    settled in the map tasks; what is left has no large group and is shuffled once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "digests",
    )
    frequent = F.broadcast(frequent_digests(rows, heavy=heavy))
    best = F.struct("doc_id", "row")
    winners = (
        rows.join(frequent, F.xxhash64("digest") == F.col("print"), "left_semi")
        .groupBy("digest")
        .agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    winners = F.broadcast(winners.select(F.col("digest").alias("won"), "best", "group_size"))
    same = F.col("digest") == F.col("won")
    settled = rows.join(winners, same).drop("won")
    group = Window.partitionBy("digest")
    rare = rows.join(winners, same, "left_anti").select(
        "*", F.max(best).over(group).alias("best"), F.count(F.lit(1)).over(group).alias("group_size")
    )
    return settled.unionByName(rare).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
