"""Every registered query against its SQL, on given and on skewed tables."""

import pytest
from conftest import SMALL
from oracle import compare, connect
from skewed import write_skewed

from __spark_entry__ import entry, queries
from seasonlab.catalog import ORACLES, QUERIES

FITTED = ["fit_poly_lasso", "position_sweep", "models_by_group", "model_weights", "results_log", "score_picks_fitted", "value_added_fitted", "line_fit", "degree_sweep"]
MODEL_DATA = "/root/testdata/sf0.01"  # the smallest tables in which leagues have all their starters


@pytest.fixture(scope="module")
def given():
    return SMALL, connect(SMALL)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = write_skewed(SMALL, str(tmp_path_factory.mktemp("skewed")))
    return folder, connect(folder)


def test_what_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"two_stage_scores"} and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(FITTED)))
def test_query_equals_sql(spark, given, name):
    folder, con = given
    assert compare(spark, con, name, folder) is None


HOT_KEYED = [
    "path_summary",
    "position_averages",
    "snake_pick",
    "rank_in_group",
    "best_lineup",
    "weekly_scores",
    "collapse_duplicates",
    "leader_change",
    "share_of_group",
    "softmax_group",
    "join_full_skewed",
    "completed_store",
    "missing_offsets",
    "path_leagues_indexed",
    "sampled_order",
    "group_profile",
    "replacement_level",
    "score_picks",
    "incremental_ingest",
]


@pytest.mark.parametrize("name", HOT_KEYED)
def test_query_equals_sql_with_a_hot_key(spark, skewed, name):
    folder, con = skewed
    assert compare(spark, con, name, folder) is None


@pytest.mark.parametrize("name", FITTED)
def test_fits_equal_sql(spark, name):
    assert compare(spark, connect(MODEL_DATA), name, MODEL_DATA) is None


@pytest.mark.parametrize("name", [n for n in FITTED if n not in ("line_fit", "degree_sweep")])
def test_no_complete_league_gives_no_models(spark, given, name):
    """At the smallest scale no league has all its starters."""
    folder, con = given
    assert compare(spark, con, name, folder) is None
    assert queries()[name](spark, folder).drop("league", "team", "player_id", "pos").dropna("all").count() == 0


def test_two_stages_score_every_listed_row(spark):
    rows = queries()["two_stage_scores"](spark, SMALL)
    assert rows.count() > 0 and rows.where("pred IS NULL OR var_pred IS NULL").count() == 0


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    for name in ("path_summary", "expected_outcome", "models_by_group", "two_stage_fit"):
        queries()[name](spark, MODEL_DATA if name == "models_by_group" else SMALL).count()
        assert not list(spark.sparkContext._jsc.getPersistentRDDs()), name


def test_path_filters_reach_the_stored_picks(spark):
    plan = queries()["path_leagues"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(EqualTo(pick," in plan and "lineitem" not in plan


def test_written_tables_are_dropped(spark):
    import os

    from seasonlab import session

    queries()["path_leagues"](spark, SMALL).count()
    paths = [p.removeprefix("file://") for p in session._written[spark.sparkContext.applicationId]]
    assert session._derived and any(os.path.exists(p) for p in paths)
    session.drop_written(spark)
    assert not session._derived and not any(os.path.exists(p) for p in paths)


def test_entry(spark):
    assert entry(spark).count() == 98


def test_projection_and_filter_reach_the_scan(spark):
    plan = queries()["scan_project"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["value_added_fitted", "score_picks_fitted", "line_fit"])
def test_order_lines_are_not_read_again_by_every_step(spark, name):
    """Members and outcomes are made once; what a query goes on with are the written rows."""
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_suppkey" not in plan and "l_shipdate" not in plan
