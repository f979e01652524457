"""Readers and writers. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonlab.operators import join_to_groups

# Endings of saved ranking lists and the scoring variant they hold.
RANKING_SUFFIXES = {
    "adp.parquet": "PPR",
    "adp_full.parquet": "PPR",
    "adp_nppr.parquet": "NPPR",
    "adp_nppr_full.parquet": "NPPR",
}


def read_tables(spark: SparkSession, *paths: str) -> DataFrame:
    """Stored tables with the same columns as one."""
    return reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(p) for p in paths])


def read_by_suffix(spark: SparkSession, paths: Sequence[str], suffixes: dict[str, str] = RANKING_SUFFIXES) -> dict[str, DataFrame]:
    """Tables by what the end of their path says they hold; the longest ending counts."""
    out = {}
    for path in paths:
        fits = [s for s in suffixes if path.endswith(s)]
        if not fits:
            raise ValueError(f"cannot tell what {path} holds; it must end in one of {sorted(suffixes)}")
        out[suffixes[max(fits, key=len)]] = spark.read.parquet(path)
    return out


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str, columns: list[str] | None = None, **literals: object) -> DataFrame:
    """CSV with a declared schema, a projection and constant columns (such as a year)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    df = df.select(*columns) if columns else df
    return df.withColumns({c: F.lit(v) for c, v in literals.items()}) if literals else df


def read_csv_years(spark: SparkSession, pattern: str, schema: StructType | str, year: str = "year", expression: str = r"(\d{4})[^/\d]*\.csv") -> DataFrame:
    """Every CSV that fits the pattern, with the year its path ends in.

    Works for any file system Spark reads. No matching file gives an empty table.
    """
    try:
        df = spark.read.schema(schema).option("header", True).csv(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn(year, F.lit(None).cast("int"))
    found = F.regexp_extract(F.col("_metadata.file_path"), expression, 1)
    return df.select("*", F.nullif(found, F.lit("")).cast("int").alias(year))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _gather(df, partition_by).write.mode("overwrite").option("header", True).partitionBy(*partition_by).csv(path)


def _gather(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a written partition together, in files of a useful size: without this
    every task writes a file to every partition. Adaptive execution splits a large
    partition over several tasks and merges small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _gather(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows; the schema is in the files, so there is no header to repeat."""
    _gather(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def ingest_new(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], partition: str | None = None) -> DataFrame:
    """Append the rows of a batch whose keys are not stored yet; return the stored table.

    With ``partition``, a column that follows from the key, such as its date, the store
    is partitioned by it and only the partitions that the batch touches are read.
    """
    by = [partition] if partition else []
    try:
        stored = spark.read.schema(batch.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        new = batch
    else:
        # Stored keys are first cut down to those in the batch, which is the smaller
        # side: Spark broadcasts it while it is, and the stored table is not shuffled.
        touched = touched_partitions(stored, batch, partition) if partition else stored
        incoming = batch.select(*keys).distinct()
        known = touched.select(*keys).join(incoming, keys, "left_semi").distinct()
        new = join_to_groups(batch, known, keys, "left_anti")
    append_table(new.select(*batch.columns), path, by)
    return spark.read.schema(batch.schema).parquet(path)


def touched_partitions(stored: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The partitions of a store that a batch has rows of. Their names are brought to the
    driver, so that the others' files are not even listed as input."""
    values = [r[0] for r in batch.select(partition).distinct().collect()]
    there = F.col(partition).isin([v for v in values if v is not None])
    return stored.where(there | F.col(partition).isNull() if None in values else there)
