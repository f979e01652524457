"""Mixing sources to target weights by a low-discrepancy schedule of token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import free_name, last_at_most, stored

GOLDEN = (5**0.5 - 1) / 2
CHUNK = 65_536  # slots that are ranked together
ROWS_A_BUCKET = 50_000
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source: one row per source in, one row per source out.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times all sizes; a target stops at ``most`` times its source's size and the excess is
    shared again by weight until none is above. Sorted by size per weight, the sources
    that stop come first, so the level that the rest reaches follows from running sums.
    The list of sources is a catalogue: its rows are numbered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("src"), F.lit(len(weights)))).cast("double")
    listed = sizes.withColumn("src", place).withColumn("weight", weight)
    order = [F.col("source_size") / F.col("weight"), F.col("src")]
    by_level = Window.orderBy(*order)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rest = share * F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = listed.withColumn("level", rest / left)
    holds = F.col("level") <= most * F.col("source_size") / F.col("weight")
    level = level.withColumn("level", F.min(F.when(holds, F.struct(*order, "level"))).over(whole)["level"])
    top = most * F.col("source_size")
    target = F.coalesce(F.least(top, F.col("level") * F.col("weight")), top)
    return level.select("src", "source", "source_size", target.alias("target"))


def _bucket(buckets: int) -> Column:
    return F.expr(f"CAST(conv(substr(turn, 1, 8), 16, 10) AS BIGINT) * {buckets} div 4294967296").cast("int")


def streams(sized: DataFrame, rows: int) -> DataFrame:
    """Rows with their first and last token in their source's shuffled stream.

    The shuffle is the order of md5 of the id. Its values are even, so equal slices of
    them are even ranges at any size of a source: slices are added up per source, and
    tokens inside a slice.
    """
    buckets = max(1_024, -(-rows // ROWS_A_BUCKET))
    placed = sized.withColumn("bucket", _bucket(buckets))
    slices = placed.groupBy("src", "bucket").agg(F.sum("size").alias("tokens"))
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("src", "bucket", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "bucket").orderBy("turn", "doc_id", "size", "row")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = placed.withColumn("end", upto).join(slices, ["src", "bucket"])
    return ended.withColumn("end", F.col("end") + F.col("before")).withColumn("start", F.col("end") - F.col("size"))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """Slots as (src, block, lo, hi, slot): the tokens of a source's stream that a slot takes,
    and its place in the schedule.

    The n-th point of the golden-ratio sequence falls into a source's part of the
    cumulative targets; a source's slots, ranked, take its blocks in turn and start
    again after the last. A source whose target is reached passes; at the end each
    source closes with the blocks that its target still lacks, a few at most.
    """
    spark = sources.sparkSession
    listed = sources.orderBy("src").collect()  # a row per source
    cumulative, upto = [], 0.0
    for s in listed:
        upto += s.target
        cumulative.append(upto)
    slots = int(-(-upto // block))
    parts = F.array(*[F.lit(c / upto if upto else 0.0) for c in cumulative[:-1]]) if len(cumulative) > 1 else F.array().cast("array<double>")
    hi, lo = F.expr(f"id div {CHUNK}"), F.col("id") % CHUNK
    far = (CHUNK * GOLDEN) % 1.0  # in two parts, so that far slots keep their digits
    point = F.expr("0.5D") + hi * F.lit(far) + lo * F.lit(GOLDEN)
    point = point - F.floor(point)
    drawn = spark.range(slots).select(
        F.col("id"), hi.alias("chunk"), last_at_most(max(0, len(cumulative) - 1), lambda i: F.get(parts, i) <= point).alias("src")
    )
    counts = drawn.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("src", "chunk").orderBy("id")
    ranked = drawn.withColumn("k", F.row_number().over(inside) - 1).join(counts, ["src", "chunk"])
    ranked = ranked.select("src", (F.col("k") + F.col("before")).alias("k"), F.col("id").alias("slot"))

    facts = sources.where("source_size > 0").select("src", "source_size", F.floor(F.col("target") + 0.5).alias("tokens"))
    facts = facts.withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    needs = F.expr(f"(tokens div source_size) * blocks + (tokens % source_size + {block - 1}) div {block}")
    facts = facts.withColumn("needs", needs)
    given = counts.groupBy("src").agg(F.sum("n").alias("given"))
    closing = facts.join(given, "src", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < needs")
    closing = closing.select("src", "given", F.explode(F.sequence("given", F.col("needs") - 1)).alias("k"))
    closing = closing.select("src", "k", (slots + (F.col("k") - F.col("given")) * len(listed) + F.col("src")).alias("slot"))
    taken = ranked.unionByName(closing).join(facts, "src").where("k < needs")
    first = F.col("block") * block
    return taken.select(
        "src",
        F.expr("k % blocks").alias("block"),
        "source_size",
        "slot",
        (F.col("tokens") - F.expr("k div blocks") * F.col("source_size")).alias("left"),
    ).select("src", "block", first.alias("lo"), F.least(first + block, "source_size", "left").alias("hi"), "slot")


def mix(docs: DataFrame, block: int = 1_024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row with what a mix of all sources takes of it.

    Columns: doc_id, size (words of the text; null: 0), source_size, target (both of
    its source), taken (words, repeats counted), slot (where the schedule first takes words
    of it, null if never): rows in this order are mixed evenly, whatever stretch is read. A source's taken words are its target
    rounded; no row is taken more than twice. Null sources are one source, the last.
    Rows without words are taken 0 times; a table without words has targets of 0.
    Rows with the same id and size in a source are alike and share what is taken of them.
    """
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.col(source_col).cast("string").alias("source"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("turn"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(targets(sizes), "mix-sources")
    named = sources.select("src", F.col("source").alias("name"), "source_size", "target")
    sized = rows.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name")
    placed = streams(sized, rows.count())
    blocks = F.expr(f"IF(size > 0, sequence(start div {block}, (end - 1) div {block}), array(-1L))")
    pieces = placed.select("*", F.explode(blocks).alias("block"))
    slots = schedule(sources, block)
    overlap = F.greatest(F.least("end", "hi") - F.greatest("start", "lo"), F.lit(0))
    part = F.when(F.col("hi").isNotNull(), overlap)
    met = pieces.join(slots, ["src", "block"], "left")
    out = met.groupBy("row", "doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("taken"), F.min(F.when(part > 0, F.col("slot"))).alias("slot")
    )
    return out.select("doc_id", "size", "source_size", "target", "taken", "slot")


def repeat_to_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows, all columns, each as often as the mix takes it, rounded to whole texts.

    Rows that share an id share what is taken of them; rows without words go.
    """
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col).groupBy("doc_id").agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    own, number, again = (free_name(docs, n) for n in ("_id", "_times", "_again"))
    often = F.floor(F.try_divide(F.col("_taken"), F.col("_size")) + 0.5).cast("int")
    times = taken.select(F.col("doc_id").alias(own), often.alias(number)).where(F.col(number) > 0)
    met = docs.join(times, F.col(id_col).cast("long").eqNullSafe(F.col(own)))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col(number))).alias(again)).drop(again)
