"""Rules that are rows of a table: matched by joins, so that ten thousand make no longer plan.

A rule tests one column: its value ``is`` a text, or ``has`` a text anywhere in it. It may
hold from one period and until another. Of the rules that match a row, the one with the
largest number says the new value of its target column. Rules of a later step see
what the earlier steps have made; within a step all rules see the same row.

Distinct values are matched, not rows. An ``is`` rule is met by equality. A ``has`` rule is
met by the first characters of its text, three at most, which are joined with all stretches
of that length in the values, and then compared in full. A null or empty text matches
nothing, a rule without a value says nothing, a null period lies within no bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.operators.joins import join_to_groups

RULES = "step int, rule long, field string, how string, text string, since int, until int, target string, value string"
STRETCH = 3  # characters by which values and texts meet


def _stretches(text: str):
    """All different stretches of up to ``STRETCH`` characters of a column."""
    starts = f"sequence(1, length({text}))"
    each = [f"transform({starts}, i -> substr({text}, i, {n}))" for n in range(1, STRETCH + 1)]
    return F.array_distinct(F.expr(f"IF(length({text}) > 0, concat({', '.join(each)}), array())"))


def apply_rules(df: DataFrame, rules: DataFrame, fields: Sequence[str], targets: Sequence[str], period: str | None = None, steps: Sequence[int] = (0,)) -> DataFrame:
    """Rows with the rules' values in the ``targets``; ``rules`` has the columns of ``RULES``.

    ``fields`` are the columns that rules may test, ``steps`` the steps in their order.
    """
    for step in steps:
        df = _one_step(df, rules.where(F.col("step") == step), fields, targets, period)
    return df


def _one_step(df: DataFrame, rules: DataFrame, fields: Sequence[str], targets: Sequence[str], period: str | None) -> DataFrame:
    rules = rules.where("text <> '' AND value IS NOT NULL").where(F.col("target").isin(list(targets)))
    told = [F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)]
    told.append((F.col(period).cast("int") if period else F.lit(None).cast("int")).alias("at"))
    subject = F.to_json(F.struct(*told), {"ignoreNullFields": "false"})
    rows = df.withColumn("_subject", subject)
    subjects = rows.select("_subject", *told).distinct()
    values = subjects.select("_subject", "at", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("seen")) for i, f in enumerate(fields)])))
    values = values.where("seen IS NOT NULL")

    equal = values.join(rules.where("how = 'is'").withColumn("seen", F.col("text")), ["field", "seen"])
    begun = rules.where("how = 'has'").withColumn("part", F.substring("text", 1, STRETCH))
    parts = values.withColumn("part", F.explode(_stretches("seen")))
    held = parts.join(begun, ["field", "part"]).where(F.contains("seen", "text"))
    columns = ["_subject", "at", "rule", "since", "until", "target", "value"]
    met = equal.select(*columns).unionByName(held.select(*columns))
    met = met.where("(since IS NULL OR at >= since) AND (until IS NULL OR at <= until)")
    last = met.groupBy("_subject", "target").agg(F.max_by("value", F.struct("rule", "value")).alias("value"))
    said = last.groupBy("_subject").agg(F.map_from_entries(F.collect_list(F.struct("target", "value"))).alias("_said"))
    out = join_to_groups(rows, said, ["_subject"])
    new = [F.coalesce(F.try_element_at("_said", F.lit(c)).cast(df.schema[c].dataType), F.col(c)).alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns]
    return out.select(*new)
