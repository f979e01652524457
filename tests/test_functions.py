import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasonlab.functions import (
    Choice,
    Scoring,
    clean_name,
    ends_with_tm,
    first_digits,
    flag,
    make_choice,
    one_hot,
    parse_number,
    pick_owner,
    round_of_pick,
    season_of,
    snake_pick,
    snake_team,
    split_element,
    to_timestamp,
    uniform_from_hash,
)
from seasonlab.functions.scoring import score_season_stats, score_violations
from seasonlab.plans.paths import pick_number


def values(df):
    return [tuple(r) for r in df.collect()]


def test_missing_split_element_and_no_digits_are_null(rows):
    df = rows([("GNB / 2nd / 45th pick / 2016",), ("no parts",), (None,)], "t string")
    out = df.select(first_digits(split_element("t", "/", 2)), split_element("t", "/", 9), first_digits("t"))
    assert values(out) == [("45", None, "2"), (None, None, None), (None, None, None)]


def test_split_takes_the_separator_literally(rows):
    df = rows([("a.b|c",)], "t string")
    assert values(df.select(split_element("t", ".", 1), split_element("t", "|", 1))) == [("b|c", "c")]


def test_null_team_is_not_a_multi_team(rows):
    df = rows([("KANTM",), ("KAN",), (None,)], "tm string")
    assert values(df.select(ends_with_tm("tm"))) == [(True,), (False,), (False,)]


def test_flag_of_a_null_comparison_is_zero(rows):
    df = rows([("a", "a"), ("a", "b"), (None, "a")], "x string, y string")
    assert values(df.select(flag(F.col("x") == F.col("y")))) == [(1,), (0,), (0,)]


def test_one_hot_of_an_absent_position(rows):
    df = rows([("QB",), ("RB",), (None,)], "pos string")
    assert values(df.select(*one_hot("pos", ["QB", "RB", "TE"]))) == [(1, 0, 0), (0, 1, 0), (0, 0, 0)]


def test_numbers_from_text(rows):
    df = rows([("1.5",), ("Rk",), ("",), (None,)], "t string")
    assert values(df.select(parse_number("t"))) == [(1.5,), (None,), (None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(parse_number("t", strict=True)).collect()


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Tom Brady*+", "Tom Brady"),
        ("Will Fuller V (R)", "Will Fuller V"),
        ("Robert Griffin III", "Robert Griffin"),
        ("Odell Beckham II ", "Odell Beckham"),
        ("GIANNI", "GIANNI"),
    ],
)
def test_clean_name(rows, raw, clean):
    assert values(rows([(raw,)], "n string").select(clean_name("n"))) == [(clean,)]


def test_season_and_timestamp(rows):
    df = rows([("2022-09-11", "1:00PM"), ("2023-01-08", "12:05AM")], "d string, t string")
    out = df.select(season_of(F.col("d").cast("date")), to_timestamp("d", "t"))
    assert values(out) == [
        (2022, datetime.datetime(2022, 9, 11, 13, 0)),
        (2022, datetime.datetime(2023, 1, 8, 0, 5)),
    ]


@pytest.mark.parametrize("teams", [2, 8, 10, 12])
def test_snake_round_trip(spark, teams):
    picks = spark.range(1, teams * 14 + 1).select(F.col("id").cast("int").alias("pick"))
    out = picks.withColumns({"round": round_of_pick("pick", teams), "seat": snake_team("pick", teams)})
    out = out.select("pick", "round", "seat", snake_pick("seat", "round", teams), pick_owner("pick", teams)).collect()
    assert all(r[0] == r[3] == pick_number(r[2], r[1], teams) and r[4] == f"team_{r[2]}" for r in out)
    for round_ in range(1, 15):
        assert {r[2] for r in out if r[1] == round_} == set(range(1, teams + 1))


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 30), st.integers(1, 20))
def test_pick_numbers_mirror_in_even_rounds(team, round_):
    teams = 30
    first, second = pick_number(team, 2 * round_ - 1, teams), pick_number(team, 2 * round_, teams)
    assert first + second == 2 * teams * (2 * round_ - 1) + 1


def test_pick_number_refuses_unknown_teams():
    with pytest.raises(ValueError):
        pick_number(11, 1, 10)


def test_uniform_is_fixed_and_inside_zero_one(spark):
    out = spark.range(1000).select(uniform_from_hash(F.lit(3), F.col("id")).alias("u"))
    first = [r.u for r in out.collect()]
    assert sorted(first) == sorted(r.u for r in out.repartition(3).collect())
    assert 0 < min(first) and max(first) < 1 and 0.45 < sum(first) / 1000 < 0.55


def test_choice_from_ids_and_positions():
    assert make_choice(["a", "b", "a"], 3, ["QB"]) == Choice(3, ids=("a", "b"))
    assert make_choice(["AvgQB"], 3, ["QB"]) == Choice(3, positions=("QB",))
    assert make_choice(["AvgQB", "z"], 3, ["QB"]) == Choice(3, ids=("z",), positions=("QB",))
    assert make_choice(["AvgK"], 3, ["QB"]) == Choice(3, ids=("AvgK",))


def test_choice_with_text_predicate(rows):
    df = rows([(1, "a", "QB", 5), (1, "b", "RB", 9), (2, "a", "QB", 9)], "pick int, player_id string, pos string, n int")
    assert values(df.where(Choice(1, where="n > 6").column()).select("player_id")) == [("b",)]


def test_scoring_variants():
    assert (Scoring("PPR").rec_weight, Scoring("HPPR").rec_weight, Scoring("NPPR").rec_weight) == (1.0, 0.5, 0.0)
    assert Scoring("HPPR").points == "Pts_HPPR" and Scoring("NPPR").ranking == "AverageDraftPosition"
    with pytest.raises(ValueError):
        Scoring("XPPR")


def test_season_stats_are_cleaned_and_scored(rows):
    scoring = Scoring("PPR")
    stats = [*scoring.weights]
    schema = "Rk string, Player string, FantPos string, FantPt string, PPR string, " + ", ".join(
        f"`{c}` string" for c in stats
    )

    def line(rk, player, pos, ppr, **given):
        return (rk, player, pos, "0", ppr, *[given.get(c) for c in stats])

    data = [
        line("1", "A One*+", "RB", "21", RushYds="100", RushTD="1", Rec="3", RecYds="20"),
        line("Rk", "Player", "FantPos", None, RushYds=None),
        line("2", "B Two", None, "0", Rec="1"),
        line("3", "C Three", "QB", "1", PassYds="50", PassInt="1"),
    ]
    out = score_season_stats(rows(data, schema), scoring)
    assert sorted(values(out.select("Player", "Pts_PPR"))) == [("A One", 21.0), ("C Three", 0.0)]
    assert score_violations(out, "Pts_PPR", "PPR").count() == 0
    assert score_violations(out, "Pts_PPR", "FantPt").count() == 1
