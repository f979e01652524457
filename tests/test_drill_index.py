"""Drill-down by bitmaps against the drill-down over picks."""

import pytest
from pyspark.sql import functions as F

from seasonlab.functions import Choice
from seasonlab.plans import drill_index as d
from seasonlab.plans.paths import path_leagues


@pytest.fixture(scope="module")
def picks(spark):
    """70,000 leagues, more than two buckets; names of leagues are texts; some values are missing."""
    i = F.col("id")
    league = F.when(i % 1000 != 7, F.concat(F.lit("L"), F.floor(i / 3).cast("string")))
    rows = spark.range(210_000).select(
        league.alias("league"),
        (i % 3 + 1).cast("int").alias("pick"),
        F.when(i % 1000 != 8, F.abs(F.hash(i)) % 500).alias("player_id"),
        F.when(i % 1000 != 9, F.element_at(F.lit(["QB", "RB", "WR"]), (F.abs(F.hash(i, i)) % 3 + 1).cast("int"))).alias("pos"),
    )
    return rows.unionByName(rows.limit(50)).persist()


@pytest.fixture(scope="module")
def index(spark, picks, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    numbers = d.number_leagues(picks)
    numbers.write.parquet(f"{folder}/numbers")
    numbers = spark.read.parquet(f"{folder}/numbers")
    d.build_index(picks, numbers).write.parquet(f"{folder}/index")
    return numbers, spark.read.parquet(f"{folder}/index")


PATHS = [
    [Choice(1, positions=("QB",))],
    [Choice(1, positions=("QB", "RB")), Choice(2, positions=("WR",))],
    [Choice(1, ids=(3, 4, 5)), Choice(2, positions=("QB",)), Choice(3, ids=(1, 2), positions=("RB",))],
    [Choice(1, ids=(3,)), Choice(1, ids=(4,))],
    [Choice(9, positions=("QB",))],
    [Choice(2, ids=tuple(range(500)))],
]


@pytest.mark.parametrize("path", PATHS)
def test_answers_equal_those_of_the_picks(picks, index, path):
    numbers, table = index
    answer = d.follow(table, path)
    want = {r.league for r in path_leagues(picks.where("league IS NOT NULL"), path).collect()}
    got = [r.league for r in d.leagues_of(answer, numbers).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert d.count_leagues(answer).first().n == len(want)


def test_a_question_starts_from_an_answer(index):
    numbers, table = index
    step = d.follow(table, PATHS[2][:1])
    for condition in PATHS[2][1:]:
        step = d.follow(table, [condition], step)
    whole = d.follow(table, PATHS[2])
    assert {r.league for r in d.leagues_of(step, numbers).collect()} == {r.league for r in d.leagues_of(whole, numbers).collect()}


def test_few_and_many_are_kept_apart(index):
    numbers, table = index
    assert table.where("(few IS NULL) = (bits IS NULL)").count() == 0
    assert {r.kind for r in table.where("bits IS NOT NULL").select("kind").distinct().collect()} == {"pos"}
    assert numbers.agg(F.max("bucket")).first()[0] == 3 and numbers.count() == numbers.distinct().count()


def test_what_the_index_cannot_answer_is_refused(index):
    for bad in ([], [Choice(1)], [Choice(1, positions=("QB",), where="total > 3")]):
        with pytest.raises(ValueError):
            d.follow(index[1], bad)


def test_no_picks_give_an_empty_index(picks):
    none = picks.where("pick > 5")
    numbers = d.number_leagues(none)
    answer = d.follow(d.build_index(none, numbers), PATHS[0])
    assert answer.count() == 0 and d.count_leagues(answer).first().n == 0 and d.leagues_of(answer, numbers).count() == 0
