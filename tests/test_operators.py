import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import seasonlab.operators.ranking as ranking
from seasonlab.operators import (
    add_total,
    best_per_key,
    blend_means,
    check_same_columns,
    conditional_override,
    conditional_swap,
    count_violations,
    drop_bad_groups,
    drop_non_numeric,
    except_keys,
    full_join,
    fd_violations,
    fill_from,
    group_sum,
    join_indicator,
    join_to_groups,
    key_violations,
    map_values,
    nth_best,
    null_counts,
    number_groups,
    number_rows,
    one_hot_violations,
    pivot_values,
    prior_period,
    r2,
    share_percent,
    short_span_keys,
    top_n,
    union_missing,
    weighted_mean,
)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def hot(spark):
    """20,000 rows, a third of them in group 0, with nulls and ties in the order."""
    i = F.col("id")
    return spark.range(20000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 50).cast("int").alias("g"),
        F.when(i % 11 == 0, None).otherwise(F.abs(F.hash(i)) % 700).alias("v"),
        i,
    )


def plain_numbers(df, order):
    w = Window.partitionBy("g").orderBy(*[F.col(c).asc() if asc else F.col(c).desc() for c, asc in order])
    return df.withColumn("rn", F.row_number().over(w))


@pytest.mark.parametrize("ascending", [True, False])
def test_numbers_equal_the_plain_window(hot, ascending):
    order = [("v", ascending), ("id", True)]
    ours = number_rows(hot, ["g"], order)
    assert dict(ours.dtypes)["rn"] == "bigint"
    plain = plain_numbers(hot, order).select("g", "id", "rn")
    assert ours.select("g", "id", "rn").exceptAll(plain).count() == 0 and ours.count() == 20000


def test_a_large_group_is_spread_over_ranges(hot):
    rows, place = ranking.ranged(hot, ["g"], [("v", True), ("id", True)], 60)
    rows = rows.withColumn("_range", F.shiftright(place, 33))
    counts = [r["count"] for r in rows.where("g = 0").groupBy("_range").count().collect()]
    assert len(counts) > 15 and max(counts) < 1000
    ends = rows.where("g = 0").groupBy("_range").agg(F.min(F.struct("v", "id")).alias("a"), F.max(F.struct("v", "id")).alias("b"))
    ends = [tuple((x.v if x.v is not None else -1, x.id) for x in (e.a, e.b)) for e in ends.orderBy("_range").collect()]
    assert all(before[1] < after[0] for before, after in zip(ends, ends[1:]))


def test_a_value_held_by_all_rows_is_divided_too(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.lit(7).alias("v"), "id")
    order = [("v", False), ("id", True)]
    assert number_rows(df, ["g"], order).where("rn <> id + 1").count() == 0
    rows, place = ranking.ranged(df, ["g"], order, 30)
    assert rows.select(F.shiftright(place, 33)).distinct().count() > 20
    assert rows.columns == [*df.columns, "_place"] and ranking.ranged(rows, ["g"], order)[1] == "__place"


def test_numbers_take_the_place_of_a_column(hot):
    out = number_rows(hot.withColumn("_r", F.lit("x")).withColumn("_first", F.lit(1)).withColumn("rn", F.lit("y")), ["g"], [("id", True)])
    assert out.columns == ["g", "v", "id", "_r", "_first", "rn"] and out.where("g = 1 AND id = 1").first().rn == 1
    assert out.where("_r <> 'x' OR _first <> 1").count() == 0


def test_numbering_an_empty_table(hot):
    assert number_rows(hot.where("id < 0"), ["g"], [("id", True)]).count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "boolean", "double", "timestamp_ntz"])
def test_falling_orders_of_any_type(spark, kind):
    texts = ["b", "ba", "", "a", "é", "ab", None, "aé"]
    v = {
        "string": F.element_at(F.lit(texts), (F.col("id") % 8 + 1).cast("int")),
        "boolean": F.when(F.col("id") % 3 > 0, F.col("id") % 3 == 1),
        "double": F.col("id") % 7 - 3.5,
    }.get(kind, F.timestamp_seconds(F.col("id") * 50_000 % 777_777))
    df = spark.range(300).select(F.lit(1).alias("g"), v.cast(kind).alias("v"), "id")
    order = [("v", False), ("id", True)]
    plain = plain_numbers(df, order)
    assert number_rows(df, ["g"], order).exceptAll(plain.withColumn("rn", F.col("rn").cast("long"))).count() == 0
    assert values(ranking.best_per_key(df, ["g"], order).select("g", "v", "id")) == values(plain.where("rn = 1").select("g", "v", "id"))


def test_totals_equal_the_window(hot):
    cast = hot.withColumn("v", F.col("v").cast("long"))
    a = cast.withColumn("total", F.sum("v").over(Window.partitionBy("g"))).select("g", "id", "total")
    b = add_total(cast, ["g"], "v").select("g", "id", "total")
    assert a.exceptAll(b).count() == 0 and b.count() == 20000


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_join_to_groups_equals_the_plain_join(spark, hot, how):
    groups = spark.range(0, 40, 2).select(F.col("id").cast("int").alias("g"), (F.col("id") * 10).alias("x"))
    ours, plain = join_to_groups(hot, groups, ["g"], how), hot.join(groups, ["g"], how)
    assert ours.columns == plain.columns or set(ours.columns) == set(plain.columns)
    assert ours.select(*plain.columns).exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_join_to_groups_refuses_joins_that_keep_the_right_side(hot):
    with pytest.raises(ValueError):
        join_to_groups(hot, hot, ["g"], "full")


def test_a_hot_key_is_split_when_the_group_table_is_large(spark, hot, tmp_path):
    rows = hot.withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    rows.write.parquet(str(tmp_path / "hot"))
    rows = spark.read.parquet(str(tmp_path / "hot"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.files.maxPartitionBytes": "200k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sums = rows.groupBy("g").agg(F.sum("v").alias("s"))
        joined = join_to_groups(rows, sums, ["g"]).select(F.sum(F.hash("id", "pad", "s")))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top_n_cuts_groups_before_the_shuffle(hot):
    out = top_n(hot, ["g"], [("v", False), ("id", True)], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert out.groupBy("g").count().where("count > 3").count() == 0


def test_top_n_beyond_sparks_own_limit(hot):
    out = top_n(hot, ["g"], [("v", True), ("id", True)], 1500)
    assert out.where("g = 0").count() == 1500


def test_best_per_key_prefers_known_scores_and_breaks_ties(rows):
    df = rows([(1, None, "a"), (1, 5, "c"), (1, 5, "b"), (2, None, "z")], "k int, v int, t string")
    out = best_per_key(df, ["k"], [("v", False), ("t", True)], count="n")
    assert values(out) == [(1, 5, "b", 3), (2, None, "z", 1)]


def test_best_per_key_combines_before_the_shuffle(hot):
    plan = best_per_key(hot, ["g"], [("v", False), ("id", True)])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_nth_best_of_a_short_group_is_absent(rows):
    df = rows([("QB", i) for i in range(5)] + [("TE", 1)], "pos string, v int")
    out = nth_best(df, "pos", [("v", False)], {"QB": 5, "TE": 2})
    assert values(out.select("pos", "v")) == [("QB", 0)]


def test_null_keys_drop_out_and_all_null_sums_are_zero(rows):
    df = rows([("a", None), ("a", None), (None, 4.0), ("b", 2.0)], "k string, v double")
    assert values(group_sum(df, ["k"], {"v": "s"}, "n")) == [("a", 0.0, 2), ("b", 2.0, 1)]


def test_weighted_mean_without_weight_is_null(rows):
    df = rows([(5.0, 0), (7.0, 0)], "v double, w int")
    assert values(df.agg(weighted_mean(F.col("v"), F.col("w")))) == [(None,)]
    df = rows([(5.0, 1), (8.0, 2)], "v double, w int")
    assert values(df.agg(weighted_mean(F.col("v"), F.col("w")))) == [(7.0,)]


def test_share_of_an_empty_total_is_null(rows):
    assert values(share_percent(rows([("a", 0)], "k string, count int"), "count")) == [("a", 0, None)]
    df = rows([("a", 1), ("b", 3)], "k string, count int")
    assert values(share_percent(df, "count")) == [("a", 1, 25.0), ("b", 3, 75.0)]


def test_blend_takes_the_one_present(rows):
    a = rows([(1, 10.0), (2, 20.0), (None, 1.0)], "k int, x double")
    b = rows([(2, 30.0), (3, 40.0), (None, 2.0)], "k int, y double")
    assert values(blend_means(a, b, ["k"], "x", "y", "z")) == [(1, 10.0), (2, 25.0), (3, 40.0)]


def test_blend_of_repeated_keys_is_the_mean_over_pairs(rows):
    a, b = [1.0, 4.0], [2.0, 3.0, 10.0]
    out = blend_means(rows([(1, v) for v in a], "k int, x double"), rows([(1, v) for v in b], "k int, y double"), ["k"], "x", "y", "z")
    pairs = [(x + y) / 2 for x in a for y in b]
    assert out.first()["z"] == pytest.approx(sum(pairs) / len(pairs))


def test_pivot_keeps_declared_categories(rows):
    df = rows([(1, "QB", 2), (1, "RB", 3), (2, "K", 9)], "k int, pos string, v int")
    out = pivot_values(df, ["k"], "pos", ["v"], ["QB", "RB", "TE"], ("v_RB",))
    assert out.columns == ["k", "v_QB", "v_TE"] and values(out) == [(1, 2, None)]


def test_r2(rows):
    df = rows([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 3.0)], "y double, p double")
    mean = 7 / 3
    expected = 1 - (0.25 + 0 + 1) / sum((v - mean) ** 2 for v in (1, 2, 4))
    assert r2(df, "y", "p").first()["r2"] == pytest.approx(expected)
    assert r2(rows([(1.0, 1.0)], "y double, p double"), "y", "p").first()["r2"] is None


def test_indicator_names_the_sides(rows):
    left, right = rows([(1, "a"), (2, "b")], "k int, x string"), rows([(2, "c"), (3, "d")], "k int, y string")
    assert values(join_indicator(left, right, ["k"])) == [
        (1, "a", None, "left_only"),
        (2, "b", "c", "both"),
        (3, None, "d", "right_only"),
    ]


def test_prior_period_does_not_skip_a_gap_year(rows):
    df = rows([(1, 2015, "a"), (1, 2017, "b")], "id int, season int, tm string")
    out = prior_period(df, "id", "season", {"tm": "prv"})
    assert values(out) == [
        (1, 2015, "a", None, "left_only"),
        (1, 2016, None, "a", "right_only"),
        (1, 2017, "b", None, "left_only"),
        (1, 2018, None, "b", "right_only"),
    ]


def test_overrides_run_in_order_and_leave_nulls(rows):
    df = rows([("a", 1), ("b", 2), (None, 3)], "x string, n int")
    out = conditional_override(df, [(F.col("x") == "a", "x", "b"), (F.col("x") == "b", "n", 9)])
    assert values(out) == [("b", 9), ("b", 9), (None, 3)]


def test_mapping_keeps_what_is_not_listed(rows):
    df = rows([("GB", 1), ("CHI", 2), (None, 3)], "tm string, n int")
    table = rows([("GB", "GNB"), ("GB", "ZZZ")], "old string, new string")
    expected = [("CHI", 2), ("GNB", 1), (None, 3)]
    assert values(map_values(df, "tm", {"GB": "GNB"})) == values(map_values(df, "tm", table)) == expected


def test_fill_swap_and_numeric(rows):
    df = rows([(None, "x", None), ("1", "y", "@")], "a string, b string, m string")
    assert values(fill_from(df, {"a": F.col("b"), "m": "-"})) == [("1", "y", "@"), ("x", "x", "-")]
    assert values(conditional_swap(df, "m", "a", "b", ("h", "w")).select("h", "w")) == [("y", "1"), (None, "x")]
    assert values(drop_non_numeric(df, "a").select("a")) == [(1.0,)]


def test_groups_with_a_bad_row_go_as_a_whole(rows):
    df = rows([(1, 0), (1, -1), (2, 0), (2, 3)], "league int, n int")
    assert values(drop_bad_groups(df, ["league"], F.col("n") == -1)) == [(2, 0), (2, 3)]


def test_union_and_except(rows):
    a, b = rows([(1, "x")], "k int, x string"), rows([(2, 3.0)], "k int, y double")
    assert values(union_missing(a, b, b)) == [(1, "x", None), (2, None, 3.0), (2, None, 3.0)]
    assert values(except_keys(rows([(1,), (1,), (2,)], "k int"), b, ["k"])) == [(1,)]


def test_quality_checks(rows):
    df = rows([("a", 2015), ("a", 2023), ("b", 2016), ("c", 2016), (None, 2016)], "tm string, year int")
    assert values(short_span_keys(df, "tm", "year", 8, ["c"])) == [("b", 2016, 2016)]
    assert values(fd_violations(df, "tm", "year")) == [("a", 2015, 2023)]
    assert values(count_violations(df, ["tm"], 1)) == [("a", 2)]
    assert values(key_violations(df, ["year"])) == [(2016, 3)]
    assert values(null_counts(df)) == [(1, 0)]
    dummies = rows([(1, 0), (0, 0), (1, 1)], "x int, y int")
    assert values(one_hot_violations(dummies, ["x", "y"])) == [(0, 0), (1, 1)]
    assert check_same_columns({1: df, 2: df.limit(1)}) and not check_same_columns({1: df, 2: dummies})


def test_numbering_random_orders(spark):
    rng = random.Random(5)
    data = [(rng.choice("aab"), rng.choice([None, 1, 2, 3]), rng.random(), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, a int, b double, i int")
    order = [("a", False), ("b", False), ("i", True)]
    plain = plain_numbers(df, order).select("i", "rn").collect()
    assert sorted(number_rows(df, ["g"], order).select("i", "rn").collect()) == sorted(plain)


def plain_full(left, right, found):
    """Full outer join on null-safe keys, row by row."""
    out, met = [], set()
    for row in left:
        partners = [(j, r) for j, r in enumerate(right) if r[:2] == row[:2]]
        met |= {j for j, _ in partners}
        out += [(*row, *r[2:], "both") for _, r in partners] or [(*row, None, "left_only")]
    out += [(*r[:2], None, *r[2:], "right_only") for j, r in enumerate(right) if j not in met]
    return sorted(out, key=repr) if found else sorted((r[:-1] for r in out), key=repr)


@pytest.mark.parametrize("least", [0, 3, 10_000])
@pytest.mark.parametrize("salts", [1, 5])
def test_full_join_equals_the_plain_one(spark, monkeypatch, least, salts):
    """Hot keys on the left, the right and both, alone and matched, null keys, equal rows."""
    import seasonlab.operators.joins as j

    monkeypatch.setattr(j, "HOT_LEAST", float(least))
    rng = random.Random(9)
    key = lambda: (rng.choice([None, None, 1, 1, 2, 3, 4, 5]), rng.choice([None, "a", "a", "b"]))
    left = [(*key(), rng.randrange(4)) for _ in range(90)] + [(7, "hot", 1)] * 60 + [(8, None, 2)] * 50 + [(9, "x", 3)]
    right = [(*key(), rng.randrange(4)) for _ in range(40)] + [(9, "x", 4)] * 55 + [(8, None, 5)] + [(10, "only", 6)] * 45
    a, b = spark.createDataFrame(left, "k int, m string, x int"), spark.createDataFrame(right, "k int, m string, y int")
    assert values(j.full_join(a, b, ["k", "m"], salts=salts)) == plain_full(left, right, False)
    assert values(j.full_join(a, b, ["k", "m"], "found", salts)) == plain_full(left, right, True)
    assert j.full_join(a, b, ["k", "m"]).columns == ["k", "m", "x", "y"]


def test_full_join_of_empty_tables(spark, hot):
    none = hot.where("id < 0").withColumnsRenamed({"v": "w", "id": "i"})
    assert full_join(hot, none, ["g"]).count() == 20000 and full_join(none, hot, ["g"]).count() == 20000
    assert full_join(none, none.withColumnsRenamed({"w": "a", "i": "b"}), ["g"]).count() == 0


def test_no_task_of_a_full_join_holds_the_hot_keys(spark, monkeypatch):
    """A third of the rows has one key and a third null; rows per partition after the shuffle."""
    import seasonlab.operators.joins as j

    monkeypatch.setattr(j, "HOT_LEAST", 100.0)
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 3 == 1, i)
    left = spark.range(30_000).select(key.alias("k"), i.alias("x"))
    right = spark.range(0, 30_000, 5).where("id % 3 = 1 OR id = 0").select(F.when(i > 0, i).otherwise(0).alias("k"), i.alias("y")).union(spark.createDataFrame([(None, -1)], "k long, y long"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = j.full_join(left, right, ["k"], salts=64)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        plain = left.join(right, left.k.eqNullSafe(right.k), "full")
        worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert worst >= 10_000 > 1.2 * max(sizes) or max(sizes) < worst
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("large", [10, 10**9])
def test_small_groups_are_numbered_in_one_shuffle(spark, hot, monkeypatch, large):
    """Groups beyond the limit are numbered by ranges, null keys like any other."""
    monkeypatch.setattr(ranking, "LARGE", large)
    calls, real = [], ranking.number_rows
    monkeypatch.setattr(ranking, "number_rows", lambda *a: calls.append(1) or real(*a))
    rows = hot.withColumn("g", F.when(F.col("id") % 5 != 0, F.col("g"))).unionByName(hot.where("id < 0"))
    ours = number_groups(rows, ["g"], [("v", True), ("id", True)], "pick")
    plain = rows.withColumn("pick", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("long"))
    assert ours.columns == plain.columns and ours.count() == plain.count() and ours.exceptAll(plain).count() == 0
    assert bool(calls) == (large == 10)
    shuffles = ours._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert large == 10 or shuffles == 1
