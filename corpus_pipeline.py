"""The corpus pipeline, and all queries of the text operators.

documents -> language ID -> one of each group of near copies -> no benchmark passages
-> sources mixed to their targets -> shards of near-equal size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seasonlab.llm import queries
from seasonlab.llm.benchmark import decontaminate
from seasonlab.llm.common import stored, table
from seasonlab.llm.jaccard import keep_one
from seasonlab.llm.langid import keep_identified
from seasonlab.llm.mixing import repeat_to_mix
from seasonlab.llm.shards import shard_by_size


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the network is sure of; others go."""
    return keep_identified(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    return repeat_to_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return shard_by_size(docs)


STAGES = [("language", language), ("near", near), ("benchmark", benchmark), ("mixing", mixing), ("sharding", sharding)]

ORACLE_SQL = None  # the language network is not SQL; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**queries.QUERIES, "pipeline": run}
ORACLES = dict(queries.ORACLES)
