import random

import pytest
from pyspark.sql import functions as F

from seasonlab.functions import Choice, make_choice
from seasonlab.plans import paths

POSITIONS = ["QB", "RB", "WR", "TE"]


@pytest.fixture(scope="module")
def data():
    """300 drafts of 3 teams and 4 rounds out of 14 players."""
    rng = random.Random(9)
    pos = {f"p{i:02}": POSITIONS[i % 4] for i in range(14)}
    out = []
    for league in range(300):
        order = sorted(pos, key=lambda p: int(p[1:]) + rng.random() * 6)[:12]
        totals = {t: rng.randint(500, 900) / 4 for t in (1, 2, 3)}
        for pick, player in enumerate(order, start=1):
            round_ = (pick + 2) // 3
            seat = (pick - 1) % 3 + 1
            team = seat if round_ % 2 else 4 - seat
            out.append((f"L{league}", f"team_{team}", pick, player, pos[player], totals[team]))
    return out


@pytest.fixture(scope="module")
def picks(spark, data):
    return spark.createDataFrame(data, "league string, team string, pick int, player_id string, pos string, total double").persist()


@pytest.fixture(scope="module")
def info(spark):
    """One player is unknown and one lacks a prediction."""
    listed = [(f"p{i:02}", POSITIONS[i % 4], f"Name {i}", "KAN", None if i == 5 else 10.0 * i, 1.0 * i) for i in range(14) if i != 2]
    return spark.createDataFrame(listed, "player_id string, pos string, player string, tm string, pred double, var_pred double")


def leagues_on_path(data, conditions):
    out = {r[0] for r in data}
    for pick, ids, positions in conditions:
        out &= {r[0] for r in data if r[2] == pick and (r[3] in ids or r[4] in positions)}
    return out


CASES = [
    [],
    [(1, {"p00", "p01"}, set())],
    [(1, {"p00", "p01"}, set()), (6, set(), {"RB", "WR"})],
    [(1, {"p00"}, {"QB"}), (6, set(), {"RB", "WR"}), (7, {"p09", "p07", "p05"}, set())],
]


def typed(case):
    return [Choice(p, tuple(sorted(i)), tuple(sorted(g))) for p, i, g in case]


@pytest.mark.parametrize("case", CASES)
def test_path_leagues_meet_every_condition(picks, data, case):
    got = [r.league for r in paths.path_leagues(picks, typed(case)).collect()]
    assert len(got) == len(set(got)) and set(got) == leagues_on_path(data, case)


def test_a_condition_never_adds_leagues(picks):
    sizes = [paths.path_leagues(picks, typed(case)).count() for case in CASES]
    assert sizes == sorted(sizes, reverse=True)


def test_two_hits_of_one_condition_do_not_hide_a_miss(rows):
    df = rows([("L", "team_1", 1, "a", "QB", 1.0), ("L", "team_1", 1, "b", "QB", 1.0)], "league string, team string, pick int, player_id string, pos string, total double")
    assert paths.path_leagues(df, [Choice(1, ("a", "b")), Choice(2, ("c",))]).count() == 0


@pytest.mark.parametrize("case", CASES)
def test_chosen_next_reads_the_picks_once(picks, data, case):
    out = paths.chosen_next(picks, 2, 3, typed(case), 3)
    wanted = leagues_on_path(data, case)
    assert sorted(tuple(r) for r in out.collect()) == sorted(r for r in data if r[0] in wanted and r[2] == 8)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation") == 1


@pytest.mark.parametrize("case", CASES)
def test_path_summary_equals_brute_force(picks, info, data, case):
    out = paths.path_summary(picks, info, 2, 3, typed(case), 3)
    wanted = leagues_on_path(data, case)
    rows = [r for r in data if r[0] in wanted and r[2] == 8]
    known = {r.player_id: r for r in info.collect()}
    described = {k for k, r in known.items() if r.pred is not None}
    expected = {}
    player_rows = [r for r in rows if r[3] in described]
    for player in {r[3] for r in player_rows}:
        mine = [r[5] for r in player_rows if r[3] == player]
        expected[player] = (len(mine), sum(mine) / len(mine), 100 * len(mine) / len(player_rows), known[player].pred)
    for pos in {r[4] for r in rows}:
        mine = [r for r in rows if r[4] == pos]
        preds = [known[r[3]].pred for r in mine if r[3] in described]
        mean = sum(preds) / len(preds) if preds else None
        expected[f"Avg{pos}"] = (len(mine), sum(r[5] for r in mine) / len(mine), 100 * len(mine) / len(rows), mean)
    got = {r.player_id: (r["count"], r.mean, r.pct, r.pred) for r in out.collect()}
    assert set(got) == set(expected)
    for key, want in expected.items():
        assert got[key] == tuple(None if w is None else pytest.approx(w) for w in want)


def test_counts_agree_between_levels(picks, info):
    out = paths.path_summary(picks, info, 1, 1, [], 3)
    positions = out.where("player_id like 'Avg%'").agg(F.sum("count")).first()[0]
    players = out.where("player_id not like 'Avg%'").agg(F.sum("count")).first()[0]
    left_out = paths.chosen_next(picks, 1, 1, [], 3).where("player_id in ('p02', 'p05')").count()
    assert players + left_out == positions == 300


def test_summary_is_ordered_and_can_be_rounded(picks, info):
    out = paths.path_summary(picks, info, 1, 2, [], 3, digits=1).collect()
    means = [r.mean for r in out]
    assert means == sorted(means, reverse=True) and all(m == round(m, 1) for m in means)


def test_expected_outcome_is_the_weighted_mean_of_the_summary(picks, info):
    conditions = typed(CASES[1])
    summary = paths.path_summary(picks, info, 2, 3, conditions, 3).collect()
    out = paths.expected_outcome(picks, info, 2, 3, conditions, 3).first()
    n = sum(r["count"] for r in summary)
    assert out.expected == pytest.approx(sum(r.mean * r["count"] for r in summary) / n)
    assert out.pick == 8 and out.samples == sum(r["count"] for r in summary if r.player_id.startswith("Avg"))


def test_all_before_a_choice(picks, info):
    conditions = typed(CASES[1])
    pick, summary, expected = paths.before_choice(picks, info, 2, 3, conditions, 3, digits=2)
    assert pick == 8
    assert summary.collect() == paths.path_summary(picks, info, 2, 3, conditions, 3, digits=2).collect()
    assert expected.collect() == paths.expected_outcome(picks, info, 2, 3, conditions, 3).collect()


def test_an_empty_path_gives_nothing(picks, info):
    nobody = [Choice(1, ("nobody",))]
    assert paths.path_summary(picks, info, 1, 2, nobody, 3).count() == 0
    out = paths.expected_outcome(picks, info, 1, 2, nobody, 3).first()
    assert out.expected is None and out.samples == 0


def test_repeated_ids_and_mixed_choices(picks, data):
    chosen = make_choice(["p00", "p00", "AvgRB"], 2, POSITIONS)
    got = {r.league for r in paths.path_leagues(picks, [chosen]).collect()}
    assert got == {r[0] for r in data if r[2] == 2 and (r[3] == "p00" or r[4] == "RB")}


def test_records(rows):
    out = paths.to_records(rows([("a", 1.5, None)], "id string, x double, y string")).first()["record"]
    assert out == '{"id":"a","x":1.5}'


def test_filters_reach_the_scan(spark, picks, info, tmp_path):
    path = str(tmp_path / "picks")
    picks.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = paths.chosen_next(stored, 2, 3, [Choice(1, ("p00",))], 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and plan.count("FileScan") == 1
