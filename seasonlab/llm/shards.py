"""Shards of near-equal size by sampled splitters, in DataFrame functions alone."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import last_at_most, longs, stored

ROWS_A_RANGE = 1_000_000
LEAST_RANGES = 1_024
PER_RANGE = 8
SPREAD = 2**52

Key = tuple[int, int]


def _range_of(splitters: list[Key]) -> Column:
    """Number of splitters not above the row's key (h, g)."""
    hs, gs = longs([k[0] for k in splitters]), longs([k[1] for k in splitters])

    def fits(i: Column) -> Column:
        at = F.get(hs, i)
        return (at < F.col("h")) | ((at == F.col("h")) & (F.get(gs, i) <= F.col("g")))

    return last_at_most(len(splitters), fits)


def _drawn(weight: Column) -> Column:
    """True for a row with the probability ``weight``, the same one in every run."""
    return (F.xxhash64("g", "h", F.lit(6)).bitwiseAND(F.lit(SPREAD - 1)) / SPREAD) < weight


def _quantiles(sample: list[tuple[Key, float]], parts: int) -> list[Key]:
    """Keys that cut a weighted sample into ``parts`` of equal weight."""
    sample = sorted(sample)
    total, upto, cuts = sum(w for _, w in sample), 0.0, []
    for key, weight in sample:
        if len(cuts) + 1 < parts and upto >= total * (len(cuts) + 1) / parts:
            cuts.append(key)
        upto += weight
    return sorted(set(cuts))


def splitters(keys: DataFrame, total: int, ranges: int) -> list[Key]:
    """Quantiles of a sample in which a row is drawn in proportion to its size.

    Brings about ``PER_RANGE`` keys per range to the driver, two numbers each.
    """
    rate = F.col("size") * F.lit(float(ranges * PER_RANGE)) / F.lit(float(total))
    drawn = keys.where(_drawn(rate)).select("h", "g", F.greatest(rate, F.lit(1.0)).alias("w"))
    return _quantiles([((r.h, r.g), r.w) for r in drawn.collect()], ranges)


def subdivide(keys: DataFrame, cuts: list[Key], most: int, rounds: int = 8) -> list[Key]:
    """Cut every range of more than ``most`` rows again, by a sample of its own rows."""
    for _ in range(rounds):
        placed = keys.withColumn("range", _range_of(cuts))
        over = {r["range"]: r["count"] for r in placed.groupBy("range").count().where(F.col("count") > most).collect()}
        if not over:
            return cuts
        full = longs(sorted(over))
        rate = F.lit(2.0 * PER_RANGE) / most
        drawn = placed.where(F.array_contains(full, F.col("range").cast("long")) & _drawn(rate))
        samples: dict[int, list[tuple[Key, float]]] = {}
        for r in drawn.select("range", "h", "g").collect():
            samples.setdefault(r["range"], []).append(((r.h, r.g), 1.0))
        more = {k for at, sample in samples.items() for k in _quantiles(sample, 2 * (over[at] // most + 1))}
        if more <= set(cuts):
            return cuts  # only rows of one and the same key are left together
        cuts = sorted({*cuts, *more})
    return cuts


def pack(held: list[tuple[int, int, int]], ranges: int, shards: int) -> tuple[list[int], list[int]]:
    """Shard of each range and the slot of its first row: the largest range that is left
    goes to the shard that holds least. ``held`` has (range, size, rows)."""
    shard_of, first_slot = [0] * ranges, [0] * ranges
    rows = [0] * shards
    least = [(0, s) for s in range(shards)]
    for at, size, n in sorted(held, key=lambda r: (-r[1], r[0])):
        load, s = least[0]
        shard_of[at], first_slot[at] = s, rows[s]
        rows[s] += n
        heapq.heapreplace(least, (load + size, s))
    return shard_of, first_slot


def shard_by_size(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard under the law ``bytes``: sizes of shards are near equal.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1; a null text has none),
    text_crc32, law, shard, slot (from 0 without gaps), grown_shard (null: this law does
    not keep rows in place when a shard is added).

    Rows are ordered by (hash of the text, hash of the id), which keeps equal texts
    together as far as the sizes allow and lets splitters fall between copies. Sampled
    splitters cut them into many ranges a shard, overfull ranges are cut again, sizes and
    rows of the ranges are added up exactly, and whole ranges are dealt to the shards.
    What reaches the driver are numbers per range, not per row. Rows with equal keys
    are alike, so their order does not matter. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(F.col(id_col).cast("long"), F.lit(1)).alias("g"),
        ),
        "shard-keys",
    )
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(LEAST_RANGES, -(-rows // ROWS_A_RANGE))
    cuts = splitters(keys, total, ranges) if rows else []
    cuts = subdivide(keys, cuts, max(1, 4 * rows // ranges)) if rows else cuts
    ranged = keys.withColumn("range", _range_of(cuts))

    held = ranged.groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    shard_of, first_slot = pack([tuple(r) for r in held.collect()], len(cuts) + 1, shards)
    inside = Window.partitionBy("range").orderBy("h", "g", "size", "text_crc32", "doc_id")
    return ranged.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.get(longs(shard_of), F.col("range")).cast("int").alias("shard"),
        (F.get(longs(first_slot), F.col("range")) + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
