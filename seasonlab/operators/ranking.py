"""Ordered picks within groups.

A filter on ``row_number() <= n`` lets Spark cut every group to n rows in each
map task before the shuffle (WindowGroupLimit), so top-n work does not depend on
the size of a group. Numbering all rows of a group has no such cut;
:func:`number_rows` shuffles the rows into even ranges instead, whatever their number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.session import new_path

LARGE = 100_000  # rows of a group that one task sorts easily
Order = list[tuple[str, bool]]  # (column, ascending); nulls rank as the lowest value


def _sort(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def top_n(df: DataFrame, keys: list[str], order: Order, n: int, name: str = "rn") -> DataFrame:
    """The first n rows of each group with their rank."""
    w = Window.partitionBy(*keys).orderBy(*_sort(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def nth_best(df: DataFrame, group: str, order: Order, places: dict[str, int]) -> DataFrame:
    """The row at the group's own place; a group with fewer rows gives none."""
    wanted = F.create_map(*[F.lit(x) for kv in places.items() for x in kv])
    listed = df.where(F.col(group).isin(list(places)))
    best = top_n(listed, [group], order, max(places.values()))
    return best.where(F.col("rn") == F.element_at(wanted, F.col(group)))


def best_per_key(df: DataFrame, keys: list[str], order: Order, count: str | None = None) -> DataFrame:
    """First row per key as an aggregate, which combines before the shuffle.

    ``count`` names an extra column with the size of the group.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[_rank(df, c, asc) for c, asc in order])
    aggs = [F.min_by(F.struct(*rest), rank).alias("_row")]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "_row.*", *([count] if count else []))


def _rank(df: DataFrame, column: str, asc: bool) -> Column:
    """A value that sorts ascending as the column does in the given direction."""
    col = F.col(column)
    kind = df.schema[column].dataType.simpleString()
    if asc:
        return col.alias(column)
    if kind == "string":  # digits of its bytes turned round; the end sorts after any byte
        turned = F.translate(F.hex(col), "0123456789ABCDEF", "FEDCBA9876543210")
        value = F.concat(turned, F.lit("G"))
    elif kind == "boolean":
        value = ~col
    elif kind == "date":
        value = -F.unix_date(col)
    elif kind.startswith("timestamp"):
        value = -F.unix_micros(col.cast("timestamp"))
    else:
        value = -col
    return F.struct(col.isNull().alias("unknown"), value.alias("value")).alias(column)


def ranged(df: DataFrame, keys: list[str], order: Order, ranges: int | None = None) -> tuple[DataFrame, str]:
    """The rows, sorted by (keys, order) over even ranges, as a written table, and the name
    of its column of places: the number of the range times 2**33, plus the place in it.

    One range shuffle, whose cuts Spark samples; a large group lies in several ranges.
    Written, since places must be the same for all that reads them.
    """
    place = "_place"
    while place in df.columns:
        place = f"_{place}"
    sort = [*[F.col(k).asc() for k in keys], *_sort(order)]
    parts = df.repartitionByRange(ranges, *sort) if ranges else df.repartitionByRange(*sort)
    path = new_path(df.sparkSession, "ranged")
    parts.sortWithinPartitions(*sort).withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.schema(parts.withColumn(place, F.lit(0).cast("long")).schema).parquet(path), place


def number_rows(df: DataFrame, keys: list[str], order: Order, name: str = "rn") -> DataFrame:
    """``row_number`` (a long) of every row, without one task holding a large group.

    The rows are shuffled once, into even ranges of (keys, order), and written. The rest is
    arithmetic on places: a row's number is its place less the first of its group in its
    range, plus the sizes of the group's earlier ranges. Those are a row per group and
    range, joined back; the written rows are not sorted again. ``order`` must be total
    within a group.
    """
    rows, place = ranged(df, keys, order)
    at = F.shiftright(place, 33)
    firsts = rows.groupBy(*keys, at.alias("_r")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_r"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(starts[f"_k{i}"]) for i, k in enumerate(keys)])
    joined = rows.join(starts, same & (F.shiftright(rows[place], 33) == starts["_r"]))
    numbers = (rows[place] + starts["_shift"]).alias(name)
    return joined.select(*[rows[c] for c in df.columns if c != name], numbers)


def number_groups(df: DataFrame, keys: list[str], order: Order, name: str = "rn") -> DataFrame:
    """``row_number`` (a long) of every row, for groups of which most are small.

    Rows per key are counted first, from the key columns alone. Rows of groups with more
    than ``LARGE`` rows are numbered by :func:`number_rows`; all others are shuffled once, by
    key, which is a third of what its ranges, written rows and join take. ``df`` is read
    twice, or three times if there are large groups.
    """
    w = Window.partitionBy(*keys).orderBy(*_sort(order))
    number = F.row_number().over(w).cast("long").alias(name)
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    large = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LARGE).drop("_n")
    path = new_path(df.sparkSession, "large-groups")
    large.write.parquet(path)
    found = df.sparkSession.read.schema(large.schema).parquet(path)
    if found.isEmpty():
        return df.select(*kept, number)
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(found[f"_k{i}"]) for i, k in enumerate(keys)])
    small = df.join(found, same, "left_anti").select(*kept, number)
    return small.unionByName(number_rows(df.join(found, same, "left_semi"), keys, order, name))
