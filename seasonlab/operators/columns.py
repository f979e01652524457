"""Row-wise operators: overrides, fills, mappings and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.operators.joins import join_to_groups


def conditional_override(df: DataFrame, rules: Sequence[tuple[Column, str, object]]) -> DataFrame:
    """Apply ``(condition, column, value)`` rules in order; a later rule sees the
    result of the earlier ones. A null condition leaves the value as it is."""
    for condition, column, value in rules:
        new = value if isinstance(value, Column) else F.lit(value)
        df = df.withColumn(column, F.when(condition, new).otherwise(F.col(column)))
    return df


def map_values(df: DataFrame, column: str, mapping: dict | DataFrame) -> DataFrame:
    """Replace values found in the mapping and keep the others.

    A dict becomes a literal map inside the expression. A table (first column:
    old value, second: new one) is joined; Spark broadcasts it when its measured
    size allows and shuffles it otherwise, with a frequent value spread over several
    tasks. An old value listed more than once takes the least of its new ones, so
    that no row is multiplied.
    """
    if isinstance(mapping, dict):
        pairs = [F.lit(x) for kv in mapping.items() for x in kv]
        return df.withColumn(column, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.col(column)))
    old, new = mapping.columns[:2]
    table = mapping.groupBy(F.col(old).alias("_old")).agg(F.min(new).alias("_new"))
    joined = join_to_groups(df.withColumn("_old", F.col(column)), table, ["_old"])
    return joined.withColumn(column, F.coalesce("_new", column)).select(*df.columns)


def fill_from(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill nulls from another column (a Column) or with a constant."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in defaults.items()}
    )


def conditional_swap(df: DataFrame, marker: str, first: str, second: str, names: tuple[str, str]) -> DataFrame:
    """Two columns in their order where the marker is null, exchanged where it is set."""
    plain = F.col(marker).isNull()
    return df.withColumns(
        {
            names[0]: F.when(plain, F.col(first)).otherwise(F.col(second)),
            names[1]: F.when(plain, F.col(second)).otherwise(F.col(first)),
        }
    )


def drop_non_numeric(df: DataFrame, column: str, kind: str = "double") -> DataFrame:
    """Convert a text column and drop the rows that do not parse (repeated headers)."""
    return df.withColumn(column, F.col(column).try_cast(kind)).where(F.col(column).isNotNull())
