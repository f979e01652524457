"""Rules as a table against rules tried one by one."""

import random

from pyspark.sql import functions as F

from seasonlab.operators.rules import RULES, apply_rules
from seasonlab.plans import rankings


def plain(row: dict, rules: list[tuple], steps) -> dict:
    for step in steps:
        seen = dict(row)
        for s, _, field, how, text, since, until, target, value in sorted(rules, key=lambda r: r[1]):
            v = seen[field]
            if s != step or not text or value is None or v is None:
                continue
            at = seen["year"]
            if (since is not None and (at is None or at < since)) or (until is not None and (at is None or at > until)):
                continue
            if v == text if how == "is" else text in v:
                row[target] = value
    return row


def test_rules_equal_one_after_the_other(spark):
    rng = random.Random(2)
    words = ["a", "ab", "abc", "bca", "cab", "aabbcc", "x y", "é", "", "b%c", "abcabc"]
    data = [(i, rng.choice([None, *words]), rng.choice([None, *words]), rng.choice([None, 2000, 2005, 2010])) for i in range(300)]
    rules = []
    for n in range(80):
        since, until = rng.choice([(None, None), (2003, None), (None, 2005), (2001, 2006)])
        rules.append((rng.randrange(2), n, rng.choice(["name", "team"]), rng.choice(["is", "has"]), rng.choice([None, *words, "bc", "c", "aab"]), since, until, rng.choice(["name", "team", "gone"]), rng.choice([None, *words, f"v{n}"])))
    df = spark.createDataFrame(data, "i int, name string, team string, year int")
    out = apply_rules(df, spark.createDataFrame(rules, RULES), ["name", "team"], ["name", "team"], "year", (0, 1))
    kept = [r for r in rules if r[7] != "gone"]
    want = []
    for i, name, team, year in data:
        got = plain({"name": name, "team": team, "year": year}, kept, (0, 1))
        want.append((i, got["name"], got["team"], year))
    assert out.columns == df.columns and sorted(tuple(r) for r in out.collect()) == want


def test_ten_thousand_rules_make_no_longer_plan(spark):
    df = spark.range(2_000).select(F.concat(F.lit("player "), F.col("id").cast("string")).alias("name"), F.lit("old").alias("pos"))

    def rules(n):
        return spark.range(n).select(F.lit(0).alias("step"), F.col("id").alias("rule"), F.lit("name").alias("field"), F.lit("is").alias("how"), F.concat(F.lit("player "), (F.col("id") * 2).cast("string")).alias("text"),
                                     F.lit(None).cast("int").alias("since"), F.lit(None).cast("int").alias("until"), F.lit("pos").alias("target"), F.lit("new").alias("value"))

    few, many = (apply_rules(df, rules(n), ["name"], ["pos"]) for n in (3, 10_000))
    assert few.where("pos = 'new'").count() == 3 and many.where("pos = 'new'").count() == 1_000
    lines = [x._jdf.queryExecution().optimizedPlan().toString().count("\n") for x in (few, many)]
    assert lines[0] == lines[1]


def test_spelling_rules_as_a_table(spark):
    names = ["Steve Smith", "Marvin Jones Jr.", "CJ Anderson", "Robert Griffin III", "Devin Funchess", "Mitch Trubisky", "Odell Beckham II", "Jordan Matthews", "Gardner Minshew", "A Player", None]
    data = [(n, t, p, f"{p}{k}", y) for k, n in enumerate(names) for t in ("GB", "LVR", "LAC", None) for p in ("QB", "RB", "K") for y in (2014, 2017, 2021)]
    df = spark.createDataFrame(data, "Name string, Team string, Position string, PositionRank string, Year int")
    table = spark.createDataFrame(rankings.spelling_rules(), RULES)
    ours, plain_ = rankings.normalise_by_rules(df, table), rankings.normalise_rankings(df)
    assert ours.columns == plain_.columns and ours.exceptAll(plain_).count() == 0 and ours.count() == plain_.count()


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1)], "name string, year int")
    none = spark.createDataFrame([], RULES)
    assert [tuple(r) for r in apply_rules(df, none, ["name"], ["name"], "year").collect()] == [("a", 1)]
    assert apply_rules(df.limit(0), none, ["name"], ["name"], "year").count() == 0
