import pytest
from pyspark.sql import functions as F

from seasonlab.functions import Scoring
from seasonlab.operators import key_violations
from seasonlab.plans import rankings, schedule
from seasonlab.plans import season as plan


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SEASON = "player_id string, season int, pos string, tm string, pts double, age int"


@pytest.fixture
def seasons(rows):
    return rows(
        [
            ("a", 2015, "QB", "KAN", 10.0, 24),
            ("a", 2016, "QB", "KAN", 12.0, 25),
            ("a", 2018, "QB", "DEN", 14.0, 27),
            ("b", 2018, "RB", "DEN", 5.0, 22),
            ("c", 2016, "RB", "KAN", 3.0, 30),
            ("d", 2017, "RB", None, 1.0, 21),
            ("d", 2018, "RB", "DENTM", 2.0, 22),
        ],
        SEASON,
    )


def test_collapse_marks_entities_with_several_teams(rows):
    df = rows(
        [("a", 2015, "KAN", 3.0), ("a", 2015, "DEN", 8.0), ("a", 2015, "NYJ", None), ("b", 2015, "NYJ", None)],
        "player_id string, season int, tm string, pts double",
    )
    out = plan.collapse_duplicates(df, ["player_id", "season"], "tm", "pts")
    assert values(out) == [("a", 2015, "DENTM", 8.0), ("b", 2015, "NYJ", None)]


def test_prior_period_features(seasons):
    out = plan.prior_period_features(seasons, 2019)
    got = {(r.player_id, r.season): r for r in out.collect()}
    assert len(got) == out.count() and key_violations(out, ["player_id", "season"]).count() == 0
    second = got["a", 2016]
    assert (second.prv_tm, second.prv_pts, second.prv_season, second.missing_last, second.changed_team) == ("KAN", 10.0, 2015, 0, 0)
    after_gap = got["a", 2018]
    assert (after_gap.prv_pts, after_gap.missing_last, after_gap.changed_team) == (None, 1, 0)
    assert (after_gap.year_born, after_gap.age) == (1991, 27)
    ahead = got["a", 2019]
    assert (ahead.pts, ahead.tm, ahead.prv_tm, ahead.prv_pts, ahead.changed_team, ahead.age) == (None, None, "DEN", 14.0, 1, 28)
    assert ("c", 2017) not in got and ("c", 2019) not in got
    assert got["c", 2016].age is None and got["c", 2016].year_born is None
    assert {s for (_, s), r in got.items() if r.pts is None} == {2019}
    assert all(r.missing_last == 1 for r in got.values() if r.prv_pts is None and r.prv_tm is None)


def test_a_null_team_counts_as_changed_only_with_a_prior_one(rows):
    df = rows([(None, "KAN"), (None, None), ("KAN", None), ("KAN", "KAN"), ("DEN", "KAN")], "tm string, prv_tm string")
    out = {(r.tm, r.prv_tm): r.changed_team for r in plan.changed_team(df).collect()}
    assert out == {(None, "KAN"): 1, (None, None): 0, ("KAN", None): 0, ("KAN", "KAN"): 0, ("DEN", "KAN"): 1}


def test_prior_features_take_one_shuffle(seasons):
    text = plan.prior_period_features(seasons, 2019)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text


def test_roster_fills_and_adds(seasons, rows):
    features = plan.prior_period_features(seasons, 2019)
    roster = rows(
        [("a", 2019, "LAR", "QB", "9", None), ("new", 2019, "LAR", "WR", "Rook", "LAR / 1st / 12th pick / 2019")] * 2,
        "player_id string, season int, tm string, pos string, yrs string, drafted string",
    )
    attributes = plan.roster_attributes(roster)
    assert values(attributes.select("player_id", "rookie", "draft_pick", "yrs")) == [("a", 0, None, 9), ("new", 1, "12", 0)]
    out = plan.enrich_full_outer(features, attributes, ["player_id", "season"], ["tm", "pos"], "pos")
    got = {(r.player_id, r.season): r for r in out.collect()}
    assert (got["a", 2019].tm, got["a", 2019].changed_team) == ("LAR", 1)
    assert (got["new", 2019].rookie, got["new", 2019].changed_team) == (1, 0)
    assert ("b", 2019) not in got  # predicted but on no roster
    assert key_violations(out, ["player_id", "season"]).count() == 0


def test_leader_change(rows):
    df = rows(
        [
            ("q1", 2015, "QB", "KAN", 20.0, None, 2014, None),
            ("q2", 2015, "QB", "KAN", 5.0, None, 2014, None),
            ("q3", 2015, "QB", "DENTM", 50.0, None, 2014, None),
            ("q4", 2016, "QB", "KAN", 7.0, "DEN", 2015, 11.0),
            ("w", 2016, "WR", "KAN", 9.0, "KAN", 2015, 3.0),
            ("x", 2016, "WR", "NYJ", 9.0, "DENTM", 2015, 3.0),
            ("y", 2016, "WR", "NYJTM", 9.0, None, 2015, None),
            ("z", 2016, "WR", None, 9.0, "KAN", 2015, 3.0),
        ],
        "id string, season int, pos string, tm string, pts double, prv_tm string, prv_season int, prv_pts double",
    )
    got = {r.id: r for r in plan.leader_change(df, "QB").collect()}
    assert (got["w"].old_leader, got["w"].new_leader, got["w"].leader_diff, got["w"].no_new_leader) == (20.0, 11.0, -9.0, 0)
    assert (got["x"].old_leader, got["x"].new_leader, got["x"].no_new_leader) == (None, None, 1)
    assert got["y"].no_new_leader == 0 and got["z"].no_new_leader == 1
    assert len(got) == 8


def test_share_of_group(rows):
    df = rows(
        [
            ("a", "KAN", "WR", 2016, 30.0),
            ("b", "KAN", "WR", 2016, 10.0),
            ("c", "KAN", "WR", 2016, None),
            ("d", "KANTM", "WR", 2016, 9.0),
            ("e", "DEN", "WR", 2016, None),
            ("f", None, "WR", 2016, 1.0),
        ],
        "id string, tm string, pos string, season int, prv_pts double",
    )
    got = {r.id: (r.group_total, r.group_size, r.group_share) for r in plan.share_of_group(df).collect()}
    assert got["a"] == (40.0, 3, 0.75) and got["c"] == (40.0, 3, None)
    assert got["d"] == (None, None, None) and got["f"] == (None, None, None)
    assert got["e"] == (0.0, 1, None)


@pytest.fixture
def staged(seasons, rows):
    features = plan.prior_period_features(seasons, 2019).withColumn("rookie", F.lit(0)).where("pos is not null")
    ranking = rows(
        [("a", 2018, 5.0, "DEN", "QB"), ("b", 2018, 90.0, "DEN", "RB"), ("new", 2018, 12.0, "DEN", "RB")],
        "player_id string, season int, adp double, tm string, pos string",
    )
    return plan.stage_merge(features, ranking, ["player_id", "season"], "adp", ["QB", "RB"])


def test_stage_merge(staged):
    got = {(r.player_id, r.season): r for r in staged.collect()}
    assert all(r.pos and r.QB + r.RB == 1 for r in got.values())
    assert all((r.adp is None) == (r.found_rank == "left_only") for r in got.values())
    assert all((r.rookie is None) == (r.found_rank == "right_only") for r in got.values())
    added = got["new", 2018]
    assert (added.tm, added.pos, added.drafted, added.prv_season, added.adp_sq) == ("DEN", "RB", True, 2017, 144.0)
    assert added.group_size == 2  # with b; d is a multi-team row
    assert got["c", 2016].drafted is False


def test_final_limits_and_fields(staged):
    fields = plan.add_final_fields(staged, 2015)
    assert fields.count() == staged.count() and fields.where("age is null").count() == 0
    assert fields.where("player_id = 'c'").first()["age"] == 23
    out = plan.final_limits(staged, 2015, 2019)
    assert values(out.select("player_id", "season")) == [("a", 2016), ("a", 2018), ("b", 2018), ("c", 2016), ("d", 2017), ("d", 2018)]


def test_player_pool(staged):
    doubled = staged.unionByName(staged.withColumn("adp", F.col("adp") - 1))
    out = plan.player_pool(doubled, 2018, "adp")
    got = {r.player_id: r for r in out.collect()}
    assert set(got) == {"a", "b", "d"} and out.count() == 3  # 'new' is known from the ranking only
    assert got["a"].adp == 4.0 and (got["a"].flex, got["b"].flex) == (0, 1)
    assert got["a"].team is None and got["a"].pick is None


def test_rankings_are_spelled_like_the_season_table(rows):
    df = rows(
        [
            ("Steve Smith", "GB", "WR", "WR12", 2018),
            ("Steve Smith Sr.", "LV", "WR", "WR3", 2019),
            ("Robert Griffin III", "LAR", "QB", "QB9", 2015),
            ("DJ Moore", "LAC", "WR", None, 2016),
            ("Devin Funchess", "CHI", "TE", "TE1", 2016),
            ("Harrison Butker", "KC", "K", "K1", 2016),
            ("Mitch Trubisky", None, "QB", "QB30", 2018),
        ],
        "Name string, Team string, Position string, PositionRank string, Year int",
    )
    assert values(rankings.normalise_rankings(df)) == sorted(
        [
            ("Steve Smith Sr.", "GNB", "WR", "12", 2018),
            ("Steve Smith Sr.", "OAK", "WR", "3", 2019),
            ("Robert Griffin III", "STL", "QB", "9", 2015),
            ("D.J. Moore", "SDG", "WR", None, 2016),
            ("Devin Funchess", "CHI", "WR", "1", 2016),
            ("Mitchell Trubisky", None, "QB", "30", 2018),
        ],
        key=repr,
    )
    merged = rankings.match_season_names(
        rows([("Scotty Miller", "WR", 2020), ("Ty Montgomery", "WR", 2017), ("Ty Montgomery", "WR", 2019)], "Name string, Position string, Year int")
    )
    assert values(merged) == [("Scott Miller", "WR", 2020), ("Ty Montgomery", "RB", 2017), ("Ty Montgomery", "WR", 2019)]
    points = rankings.match_ranking_positions(rows([("Ladarius Green", "WR"), ("Other", "WR")], "Player string, FantPos string"))
    assert values(points) == [("Ladarius Green", "TE"), ("Other", "WR")]


def test_rankings_per_variant(rows):
    keys = ["Name", "Year", "Team", "Position"]
    schema = "Name string, Year int, Team string, Position string, "
    ppr = rows([("A", 2016, "KAN", "QB", 4.0), ("A", 2014, "KAN", "QB", 9.0)], schema + "AverageDraftPositionPPR double")
    nppr = rows([("A", 2016, "KAN", "QB", 6.0), ("B", 2016, None, "QB", 1.0)], schema + "AverageDraftPosition double")
    half = rankings.rankings_for(Scoring("HPPR"), ppr, nppr, keys)
    assert values(half) == [("A", 2016, "KAN", "QB", 5.0)] and half.columns[-1] == "AverageDraftPositionHPPR"
    assert rankings.rankings_for(Scoring("PPR"), ppr, nppr, keys).count() == 1
    assert rankings.rankings_for(Scoring("NPPR"), ppr, nppr, keys).count() == 2


def test_schedule_and_standings(rows):
    games = rows(
        [
            ("1", "2022-09-11", "1:00PM", "KAN", "DEN", None),
            ("1", "2022-09-11", "8:15PM", "KAN", "DEN", "@"),
            ("Week", "Date", "Time", None, None, None),
            (None, "x", "y", None, None, None),
            ("SuperBowl", "2023-02-12", "6:30PM", "KAN", "PHI", None),
        ],
        "Week string, Date string, Time string, winner string, loser string, at string",
    )
    out = schedule.schedule(games)
    assert [(r.home, r.away, r.datetime.hour) for r in out.orderBy("datetime").collect()] == [("KAN", "DEN", 13), ("DEN", "KAN", 20)]
    assert schedule.schedule(games, regular_only=False).count() == 3
    head = "Tm string, W int, L int, T int, PF int, PA int"
    afc = rows([("AFC East", None, None, None, None, None), ("Buffalo Bills*", 13, 3, 0, 455, 286)], head)
    nfc = rows([("Green Bay Packers (7)", 8, 9, 0, 370, 371)], head)
    tables = schedule.standings(afc, nfc)
    assert {r.Tm for r in tables.collect()} == {"Buffalo Bills", "Green Bay Packers"}
    assert schedule.wrong_sizes(tables.withColumn("conference", F.lit("AFC"))).first()["n"] == 2


def test_steps_run_in_order(rows):
    df = rows([(1,)], "x int")
    steps = [("add", lambda d: d.withColumn("x", F.col("x") + 1)), ("times", lambda d: d.withColumn("x", F.col("x") * 10))]
    assert plan.run_steps(df, steps).first()["x"] == 20
    assert plan.run_steps(df, steps[::-1]).first()["x"] == 11
