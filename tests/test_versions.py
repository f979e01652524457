"""Tables that change in one step, and stores that know what they lack."""

import json

import pytest
from pyspark.sql import functions as F

from seasonlab.sources import ledger
from seasonlab.sources import versions as v


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (4, "a", 4.0)], "id long, kind string, x double")


def test_a_table_is_what_was_published_last(spark, table, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        v.read_current(spark, path)
    assert v.publish(table, path) == 1 and rows_of(v.read_current(spark, path)) == rows_of(table)
    assert v.publish(table.where("id < 3"), path) == 2 and v.read_current(spark, path).count() == 2
    assert rows_of(v.read_version(spark, path, 1)) == rows_of(table)
    assert v.publish(table.limit(0), path) == 3 and v.read_current(spark, path).count() == 0
    assert v.read_current(spark, path).schema == table.schema and v.kept_versions(spark, path) == [2, 3]
    with pytest.raises(FileNotFoundError):
        v.read_version(spark, path, 1)


def test_a_table_is_replaced_by_what_is_read_from_it(spark, table, tmp_path):
    path = str(tmp_path / "t")
    v.publish(table, path)
    for _ in range(3):
        now = v.read_current(spark, path)
        v.publish(now.withColumn("x", F.col("x") + 1), path)
    assert rows_of(v.read_current(spark, path)) == rows_of(table.withColumn("x", F.col("x") + 3))


def test_a_failed_check_changes_nothing(spark, table, tmp_path):
    path = str(tmp_path / "t")
    v.publish(table, path)
    before = sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    with pytest.raises(v.CheckFailed, match="null x: 1 rows"):
        v.publish(table, path, [("no rows", lambda t: t.limit(0)), ("null x", lambda t: t.where("x IS NULL"))])
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == before
    assert rows_of(v.read_current(spark, path)) == rows_of(table)


def test_a_killed_write_leaves_the_table(spark, table, tmp_path):
    """Killed while rows are written, or while the manifest is."""
    path = str(tmp_path / "t")
    v.publish(table, path)
    broken = table.withColumn("x", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        v.publish(broken, path)
    (tmp_path / "t" / v._name(2)).write_text('{"schema": ')
    assert rows_of(v.read_current(spark, path)) == rows_of(table) and v.kept_versions(spark, path) == [1]
    assert v.publish(table.where("id = 1"), path) == 3 and v.read_current(spark, path).count() == 1


def test_partitions_are_replaced_alone(spark, table, tmp_path):
    path = str(tmp_path / "t")
    v.publish(table, path, partition_by=["kind"])
    v.publish(spark.createDataFrame([(9, "a", 9.0), (10, "c", 1.0)], table.schema), path, partition_by=["kind"], replace="partitions")
    assert rows_of(v.read_current(spark, path)) == rows_of(spark.createDataFrame([(2, "b", None), (3, None, 3.0), (9, "a", 9.0), (10, "c", 1.0)], table.schema))
    v.publish(spark.createDataFrame([(11, None, 1.0)], table.schema), path, partition_by=["kind"], replace="partitions")
    now = v.read_current(spark, path)
    assert now.columns == table.columns and sorted(r.id for r in now.collect()) == [2, 9, 10, 11]
    v.publish(spark.createDataFrame([(12, "a", 1.0)], table.schema), path, partition_by=["kind"], replace="none", keep=1)
    assert sorted(r.id for r in v.read_current(spark, path).collect()) == [2, 9, 10, 11, 12]
    told = json.loads((tmp_path / "t" / v._name(4)).read_text())
    assert len(told["parts"]) == 4 and v.kept_versions(spark, path) == [4]
    with pytest.raises(ValueError):
        v.publish(table, path, partition_by=["id"], replace="partitions")
    with pytest.raises(ValueError):
        v.publish(table, path, replace="partitions")


def test_partitions_keep_their_types(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "007", 2001), (2, "1e3", 2002)], "id long, code string, year int")
    v.publish(df, path, partition_by=["year", "code"])
    v.publish(df.where("id = 2"), path, partition_by=["year", "code"], replace="partitions")
    assert rows_of(v.read_current(spark, path)) == rows_of(df) and v.read_current(spark, path).dtypes == df.dtypes


def test_the_second_of_two_writers_fails(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    v.publish(table, path)

    def meanwhile(t):
        if not other:
            other.append(v.publish(table.where("id = 1"), path))
        return t.limit(0)

    other = []
    with pytest.raises(v.Conflict):
        v.publish(table.where("id = 2"), path, [("a slow check", meanwhile)])
    assert other == [2] and [r.id for r in v.read_current(spark, path).collect()] == [1]


def plain_gaps(stored, first, last):
    out = []
    for k in range(first, last + 1):
        if k not in stored:
            if out and out[-1][1] == k - 1:
                out[-1][1] = k
            else:
                out.append([k, k])
    return [tuple(g) for g in out]


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_missing_ranges(spark, block):
    import random

    rng = random.Random(3)
    stored = [("a", rng.randrange(-20, 200)) for _ in range(260)] + [("b", k) for k in range(50)] + [("a", None), (None, 3), ("z", 4)]
    expected = [("a", -5, 190), ("b", 0, 49), ("c", 3, 30), ("d", 5, 4), ("e", 8, 8), ("a", -5, 195)]
    found = ledger.missing_ranges(spark.createDataFrame(stored, "k string, o long"), spark.createDataFrame(expected, "k string, first long, last long"), ["k"], "o", block)
    want = [("a", *g) for g in plain_gaps({o for k, o in stored if k == "a"}, -5, 195)] + [("c", 3, 30), ("e", 8, 8)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_only_what_is_missing_is_fetched(spark):
    source = spark.range(1000).select(F.lit("s").alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("x"))
    asked = []

    def fetch(ranges):
        asked.append(sorted((r.start, r.end) for r in ranges.collect()))
        return ledger.rows_in_ranges(source.where("o <> 42"), ranges, ["k"], "o", 64)

    expected = spark.createDataFrame([("s", 0, 999)], "k string, first long, last long")
    stored = source.where("o NOT BETWEEN 10 AND 99 AND o <> 500")
    for _ in range(2):
        stored = stored.unionByName(ledger.complete(stored, expected, ["k"], "o", fetch))
    assert asked == [[(10, 99), (500, 500)], [(42, 42)]] and rows_of(stored) == rows_of(source.where("o <> 42"))


def test_an_empty_store_lacks_everything(spark):
    none = spark.createDataFrame([], "k string, o long")
    expected = spark.createDataFrame([("s", 3, 9000)], "k string, first long, last long")
    assert [tuple(r) for r in ledger.missing_ranges(none, expected, ["k"], "o").collect()] == [("s", 3, 9000)]
    assert ledger.missing_ranges(none, expected.limit(0), ["k"], "o").count() == 0
