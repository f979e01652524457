"""Incremental ingest as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonlab.operators import join_to_groups
from seasonlab.sources.files import ingest_new


def ingest_stream(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, keys: list[str], partition: str | None = None) -> DataFrame:
    """Take in the files that arrived since the last run and stop.

    The checkpoint remembers files already read. A key belongs to the first file that
    brings it: within a batch by file name, across batches by the stored keys, also
    when a batch is run again after a failure.
    """

    def take(batch: DataFrame, _: int) -> None:
        first = batch.groupBy(*keys).agg(F.min("_file").alias("_file"))
        kept = join_to_groups(batch, first, [*keys, "_file"], "left_semi").drop("_file")
        ingest_new(batch.sparkSession, kept, target, keys, partition)

    stream = spark.readStream.schema(schema).parquet(source).select("*", F.col("_metadata.file_path").alias("_file"))
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)
