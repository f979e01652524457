"""Lineups and roster profiles against plain Python on small random data."""

import random

import pytest
from pyspark.sql import functions as F

from seasonlab.plans import lineup, profile, sampling
from seasonlab.plans.lineup import Slots

SLOTS = Slots()
POSITIONS = ["QB", "RB", "WR", "TE", "K"]


@pytest.fixture(scope="module")
def weekly_rows():
    rng = random.Random(1)
    data = []
    for week in range(1, 5):
        for team in ("team_1", "team_2", "team_3"):
            for i in range(rng.randint(3, 14)):
                data.append((week, team, f"p{i}", rng.choice(POSITIONS), float(rng.randint(0, 30))))
    return data


def expected_lineup(data):
    totals = {}
    for week, team in {(r[0], r[1]) for r in data}:
        mine = [r for r in data if (r[0], r[1]) == (week, team)]
        used, spare = [], []
        for pos, quota in SLOTS.quotas.items():
            ordered = sorted((r for r in mine if r[3] == pos), key=lambda r: (-r[4], r[2]))
            used += [(pos, r[4]) for r in ordered[:quota]]
            spare += [r for r in ordered[quota:] if pos in SLOTS.flex]
        if spare:
            used.append(("FLEX", max(r[4] for r in spare)))
        for pos, pts in used:
            totals[team, pos] = totals.get((team, pos), 0.0) + pts
    return totals


def test_best_lineup_equals_brute_force(spark, weekly_rows):
    df = spark.createDataFrame(weekly_rows, "week int, team string, player_id string, pos string, pts double")
    got = {(r.team, r.pos): r.pts for r in lineup.best_lineup(df, SLOTS).collect()}
    assert got == {k: pytest.approx(v / 18) for k, v in expected_lineup(weekly_rows).items()}


def test_best_lineup_beats_other_legal_lineups(spark, weekly_rows):
    best = sum(expected_lineup(weekly_rows).values())
    rng = random.Random(2)
    for _ in range(20):
        total = 0.0
        for week, team in {(r[0], r[1]) for r in weekly_rows}:
            mine = [r for r in weekly_rows if (r[0], r[1]) == (week, team)]
            rng.shuffle(mine)
            left = []
            for pos, quota in SLOTS.quotas.items():
                listed = [r for r in mine if r[3] == pos]
                total += sum(r[4] for r in listed[:quota])
                left += [r for r in listed[quota:] if pos in SLOTS.flex]
            total += left[0][4] if left else 0.0
        assert total <= best


def test_replacements_and_weekly_scores(rows):
    undrafted = rows([("QB", f"q{i}", 10.0 * i) for i in range(6)] + [("TE", "t", 5.0)], "pos string, id string, pts double")
    points = lineup.replacement_points(undrafted, "pts", "id")
    assert [tuple(r) for r in points.collect()] == [("QB", 10.0)]  # five tight ends are needed, one is there
    teams = rows([("team_1",), ("team_2",)], "team string")
    grid = lineup.baseline_grid(teams, points)
    assert grid.count() == 2 * 18 and grid.distinct().count() == 36
    assert grid.select("pts").distinct().first()["pts"] == pytest.approx(10 / 18)

    weekly = rows(
        [("a", "1", "12.5", "3"), ("a", "2", "DNP", None), ("z", "1", "9", "1"), ("a", "Week", "1", "1")],
        "player_id string, week string, fant_pt string, rec string",
    )
    drafted = rows([("a", "team_1", "QB")], "player_id string, team string, pos string")
    out = lineup.weekly_scores(weekly, drafted, grid, 0.5)
    mine = sorted((r.week, r.pts) for r in out.where("player_id is not null").collect())
    assert mine == [(0, 1.5), (1, 14.0), (2, 0.0)]
    assert out.where("player_id is null").count() == 72
    zero = lineup.weekly_scores(weekly, drafted, grid, 0.5, baseline_as_zero=True)
    assert zero.where("player_id is null and pts <> 0").count() == 0


@pytest.fixture(scope="module")
def members():
    rng = random.Random(3)
    data = []
    for league in (1, 2):
        for t in range(1, 7):
            count = 1 if t == 6 else rng.randint(2, 14)
            for i in range(count):
                data.append((league, f"team_{t}", f"p{league}{t}{i:02}", rng.choice(POSITIONS[:4]), rng.randint(0, 40) / 4, rng.randint(0, 40) / 4))
    return data


def expected_profile(data):
    out = {}
    for league, team in {(r[0], r[1]) for r in data}:
        mine = sorted((r for r in data if (r[0], r[1]) == (league, team)), key=lambda r: (-r[4], r[2]))
        groups = {p: [r for r in mine if r[3] == p] for p in SLOTS.positions}
        spare = [r for p in SLOTS.flex for r in groups[p][SLOTS.quotas[p] :]]
        groups["FLEX"] = sorted(spare, key=lambda r: (-r[4], r[2]))
        for pos, listed in groups.items():
            n = SLOTS.quotas.get(pos, 2)
            top, rest = listed[:n], listed[n:]
            out[league, team, pos] = (
                top[0][4] if top else 0.0,
                top[0][5] if top else 10000.0,
                top[1][4] if len(top) > 1 else 0.0,
                top[1][5] if len(top) > 1 else 10000.0,
                len(listed) - n,
                sum(r[4] for r in rest) / len(rest) if rest else 0.0,
                sum(r[5] for r in rest) / len(rest) if rest else 10000.0,
            )
    return out


@pytest.fixture(scope="module")
def profiles(spark, members):
    df = spark.createDataFrame(members, "league int, team string, player_id string, pos string, pred double, var_pred double")
    return profile.group_profile(df, SLOTS)


def test_group_profile_equals_brute_force(profiles, members):
    got = {(r.league, r.team, r.pos): tuple(r[m] for m in profile.MEASURES) for r in profiles.collect()}
    expected = expected_profile(members)
    assert set(got) == set(expected)
    for key, want in expected.items():
        assert got[key] == pytest.approx(want), key


def test_every_team_has_every_position_once(profiles):
    assert profiles.count() == 12 * 5 and profiles.select("league", "team", "pos").distinct().count() == 60


def test_profile_keeps_few_rows_per_group(profiles):
    plan = profiles._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 4, Partial" in plan and "partial_sum" in plan


def test_usable_profiles_drop_whole_leagues(profiles):
    bad = {r.league for r in profiles.where("num_others = -1").collect()}
    assert bad and {r.league for r in profile.usable_profiles(profiles).collect()} == {1, 2} - bad


def test_feature_tables(profiles):
    scored = profiles.withColumn("pts", F.col("a_pred_points") + 1)
    by = ["league", "team"]
    wide = profile.pivot_features(scored, by, "pts", SLOTS)
    assert len(wide.columns) == 2 + 7 * 4 - 4 + 1 and "b_pred_points_QB" not in wide.columns
    starter = {(r.league, r.team): r for r in profile.starter_points(scored, by, "pts").collect()}
    rows = {(r.league, r.team, r.pos): r for r in scored.collect()}
    for (league, team), r in starter.items():
        mine = {p: rows[league, team, p] for p in ("QB", "RB", "WR", "TE", "FLEX")}
        expected = sum(m.a_pred_points for m in mine.values()) + mine["RB"].b_pred_points + mine["WR"].b_pred_points
        assert r.final_pred_points == pytest.approx(expected)
        assert r.pts == pytest.approx(sum(m.pts for m in mine.values()))
    stats = {(r.league, r.team, r.pos): r for r in profile.position_stats(scored).collect()}
    some = stats[1, "team_1", "RB"]
    assert some.total_points == pytest.approx(some.num_others * some.avg_pred_points_other + some.a_pred_points + some.b_pred_points)
    assert all(r.average_points is None for r in stats.values() if r.total_players == 0)
    simple = profile.pivot_stats(scored, by, "pts", SLOTS.positions)
    assert simple.count() == 12 and set(simple.columns) >= {"average_points_QB", "std_error_TE", "pts"}


def test_regression_set_keeps_every_feature_row(spark, members):
    df = spark.createDataFrame(members, "league int, team string, player_id string, pos string, pred double, var_pred double")
    y = spark.createDataFrame([(1, "team_1", "QB", 7.0), (9, "team_9", "QB", 1.0)], "league int, team string, pos string, pts double")
    out = profile.regression_set(y, df, lambda d: profile.group_profile(d, SLOTS), ["league", "team", "pos"])
    assert out.count() == 60 and out.where("pts is not null").count() == 1


def test_score_picks(spark, profiles, members):
    df = spark.createDataFrame(members, "league int, team string, player_id string, pos string, pred double, var_pred double")
    picks = df.unionByName(df.limit(3).withColumn("team", F.lit(None).cast("string")))
    out = profile.score_picks(picks, profiles, lambda p: p.withColumn("prediction", F.col("a_pred_points")), ["league", "team"])
    assert out.count() == len(members)
    total = sum(r.a_pred_points for r in profiles.where("league = 1 and team = 'team_1'").collect())
    assert out.where("league = 1 and team = 'team_1'").first()["total"] == pytest.approx(total)


def test_replacement_level_equals_brute_force(spark):
    rng = random.Random(4)
    data = [(lg, f"p{i:03}", rng.choice(POSITIONS), rng.randint(0, 60) / 2) for lg in (1, 2) for i in range(40)]
    df = spark.createDataFrame(data, "league int, id string, pos string, pred double")
    out = sampling.replacement_level(df, ["league"], "pos", [("pred", False), ("id", True)], ["pred"], wait=11)
    got = {(r.league, r.id): (r.pred_base, r.pred_diff) for r in out.collect()}
    assert len(got) == 80
    for lg in (1, 2):
        ordered = sorted((r for r in data if r[0] == lg), key=lambda r: (-r[3], r[1]))
        for r in ordered:
            still = [x[3] for x in ordered[11:] if x[2] == r[2]][:3]
            base = sum(still) / len(still) if still else None
            assert got[lg, r[1]][0] == (None if base is None else pytest.approx(base))
            if base is not None:
                assert got[lg, r[1]][1] == pytest.approx(r[3] - base)


def test_sampled_order_follows_the_softmax(spark):
    pool = spark.createDataFrame([("y", i, float(r)) for i, r in enumerate([1, 5, 9, 20, 60])], "s string, id int, adp double")
    out = sampling.sampled_order(pool, ["s"], "id", "adp", 8.0, samples=4000, picks=4, teams=2, seed=1)
    assert out.count() == 16000 and out.groupBy("sample").agg(F.count_distinct("id").alias("n")).where("n <> 4").count() == 0
    first = {r.id: r["count"] / 4000 for r in out.where("pick = 1").groupBy("id").count().collect()}
    chance = {r.id: r.probability for r in sampling.softmax_group(pool, ["s"], "adp", 8.0).collect()}
    assert sum(chance.values()) == pytest.approx(1)
    for i, p in chance.items():
        assert first.get(i, 0.0) == pytest.approx(p, abs=0.03)
    owners = {(r.pick, r.round, r.team) for r in out.collect()}
    assert owners == {(1, 1, "team_1"), (2, 1, "team_2"), (3, 2, "team_2"), (4, 2, "team_1")}


def test_split_keeps_identifiers_together(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id")
    marked = sampling.split_by_group(df, ["k"])
    assert marked.groupBy("k").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0
    train, test = sampling.train_test(df, ["k"])
    assert train.count() + test.count() == 5000 and 0.7 < train.count() / 5000 < 0.9


def test_unknown_predictions_are_left_out_of_averages(rows):
    data = [("RB", "a", 5.0, 1.0), ("RB", "b", None, 2.0), ("RB", "c", 3.0, None), ("RB", "d", 1.0, 4.0), ("RB", "e", None, 6.0)]
    df = rows([(1, "t", *r) for r in data], "league int, team string, pos string, player_id string, pred double, var_pred double")
    out = {r.pos: r for r in profile.group_profile(df, SLOTS).collect()}
    rb, flex = out["RB"], out["FLEX"]
    assert (rb.a_pred_points, rb.b_pred_points, rb.num_others) == (5.0, 3.0, 3)
    assert (rb.avg_pred_points_other, rb.avg_std_error_other, rb.b_std_error) == (1.0, 4.0, 10000.0)
    assert (flex.a_pred_points, flex.b_pred_points, flex.num_others) == (1.0, 0.0, 1)
    assert (flex.avg_pred_points_other, flex.avg_std_error_other) == (0.0, 6.0)


def points_of_position(df):
    """A made-up model in which depth counts a little."""
    base = F.col("a_pred_points") + F.col("b_pred_points") - F.col("a_std_error") / 1000
    return df.withColumn("prediction", base + 0.1 * F.col("num_others") * F.col("avg_pred_points_other"))


def test_value_added_equals_profiles_with_the_candidate(spark, members):
    schema = "league int, team string, player_id string, pos string, pred double, var_pred double"
    df = spark.createDataFrame(members, schema)
    mine, others = df.where("team = 'team_1'"), df.where("team <> 'team_1'")
    out = profile.value_added(others, mine, SLOTS, points_of_position)
    got = {r.player_id: r.value_add for r in out.collect()}
    assert len(got) == others.count() and out.columns == [*others.columns, "value_add"]

    def total(rows, league, pos):
        a, a_error, b, _, n, mean, _ = expected_profile([r for r in rows if r[0] == league])[league, "team_1", pos]
        return a + b - a_error / 1000 + 0.1 * n * mean

    own = [r for r in members if r[1] == "team_1"]
    for league, team, player, pos, pred, error in members:
        if team != "team_1":
            added = own + [(league, "team_1", player, pos, pred, error)]
            assert got[player] == pytest.approx(total(added, league, pos) - total(own, league, pos)), player


@pytest.mark.parametrize("temperature", [0.01, 0.1, 0.5, 40.0, 1e6])
def test_softmax_at_any_temperature(spark, temperature):
    """Far ratings neither overflow nor leave a group without weight; nulls have none."""
    import math

    data = [("a", 400.0), ("a", 401.0), ("a", 401.0), ("b", -1e4), ("b", 1e5), ("c", 7.0), ("d", None), ("a", None), (None, 3.0), (None, 2.5)]
    out = sampling.softmax_group(spark.createDataFrame(data, "s string, adp double"), ["s"], "adp", temperature)
    assert out.columns == ["s", "adp", "probability"] and out.count() == len(data)
    for s in ("a", "b", "c"):
        xs = [-v / temperature for g, v in data if g == s and v is not None]
        want = sorted(math.exp(x - max(xs)) / sum(math.exp(y - max(xs)) for y in xs) for x in xs)
        got = sorted(r.probability for r in out.where(F.col("s") == s).where("adp IS NOT NULL").collect())
        assert got == pytest.approx(want, abs=1e-12)
    assert out.where("adp IS NULL AND probability IS NOT NULL").count() == 0


def test_softmax_refuses_no_temperature(spark):
    with pytest.raises(ValueError):
        sampling.softmax_group(spark.createDataFrame([("a", 1.0)], "s string, adp double"), ["s"], "adp", 0.0)
