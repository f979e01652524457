"""Registered queries: each operator on its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.llm.benchmark import contamination
from seasonlab.llm.common import table
from seasonlab.llm.exact import exact_duplicates
from seasonlab.llm.jaccard import near_duplicates
from seasonlab.llm.langid import identify
from seasonlab.llm.lines import fuzzy_lines
from seasonlab.llm.mixing import mix
from seasonlab.llm.pages import extract_pages
from seasonlab.llm.periodic import periodic_runs
from seasonlab.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from seasonlab.llm.shards import shard_by_size
from seasonlab.llm.suffixes import without_repeats
from seasonlab.llm.tokens import chars_within, prefix_counts
from seasonlab.llm.toxicity import toxicity
from seasonlab.llm.whitening import whiten

MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, row_number() OVER () AS row,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS src FROM sizes
), levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - 2.0::DOUBLE * coalesce(CAST(sum(source_size) OVER before AS DOUBLE), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE level <= 2.0::DOUBLE * source_size / weight
), aims AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM chosen) * weight, 2.0::DOUBLE * source_size)) AS target FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS tokens,
         CAST(sum(size) OVER (PARTITION BY rows.source ORDER BY turn, doc_id, size, row ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM rows JOIN aims ON rows.source IS NOT DISTINCT FROM aims.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(least(upto, tokens) - (upto - size), 0)
          + greatest(least(upto + source_size, tokens) - (upto - size + source_size), 0) AS BIGINT) AS taken
FROM placed
"""

LETTERS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {LETTERS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {LETTERS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS gram, least(len(w), 10) AS n
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
grams AS (
  SELECT row, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (SELECT row, i, n, item_id FROM grams JOIN windows USING (gram, n)),
covered AS (SELECT row, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT row, i, n FROM hits), unnest(range(0, n)) AS t(k) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT row, item_id FROM hits) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""

JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
ids AS (SELECT doc_id, md5_number_lower(g) AS g FROM s),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM ids x JOIN ids y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)
),
either AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reach(u, v) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.u, either.v FROM reach JOIN either ON reach.v = either.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.v, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u AS doc_id, min(v) AS v FROM reach GROUP BY u) m USING (doc_id)
"""


@query(JACCARD_SQL)
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(MIX_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("slot")


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_html_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query()
def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_size(table(spark, sf_dir, "documents"))


@query()
def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents"))


@query(CONTAMINATION_SQL)
def op8_benchmark_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
)
def op9_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the count, how many characters a budget of 512 tokens holds."""
    counted = prefix_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), chars_within(F.lit(512)).alias("chars_within_512"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by crc32 of the id, have words that repeat from some word on.

    Texts that are changed come back with single spaces; a null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    plan = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w").cast("long")
    plan = plan.withColumn("a", F.when(n > 0, F.col("g") % n))
    plan = plan.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    moved = F.expr("transform(sequence(0L, size(w) - 1L), i -> w[CAST(IF(i < a, i, a + (i - a) % p) AS INT)])")
    return plan.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    best = found.select("*", longest.alias("best"), F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"))
    length = -F.col("best.short")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.short) div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
