import os

import pytest

from pyspark.sql import functions as F

from seasonlab import session
from seasonlab.session import new_path, shared_folder
from seasonlab.sources import (
    append_table,
    ingest_new,
    overwrite_table,
    page_links,
    page_tables,
    table_counts,
    touched_partitions,
    read_by_suffix,
    read_csv,
    read_csv_years,
    read_tables,
    write_csv,
)
from seasonlab.streaming import ingest_stream


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x") and new_path(spark, "x").startswith(shared_folder(spark))


def test_stored_tables_are_stacked(rows, spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("one", "two")]
    overwrite_table(rows([(1, "a")], "k int, x string"), paths[0])
    overwrite_table(rows([("b", 2)], "x string, k int"), paths[1])
    overwrite_table(rows([("c", 3)], "x string, k int"), paths[1])
    assert values(read_tables(spark, *paths)) == [(1, "a"), (3, "c")]


def test_lists_by_suffix(rows, spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("adp_full.parquet", "adp_nppr.parquet")]
    for i, p in enumerate(paths):
        overwrite_table(rows([(i,)], "k int"), p)
    lists = read_by_suffix(spark, paths)
    assert {k: v.first()["k"] for k, v in lists.items()} == {"PPR": 0, "NPPR": 1}
    with pytest.raises(ValueError):
        read_by_suffix(spark, ["/x/adp.p"])


def test_csv_with_projection_and_year(rows, spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(rows([("a", 1.5, "x,y"), ("b", None, '"q"')], "k string, v double, t string"), path)
    out = read_csv(spark, path, "k string, v double, t string", ["k", "t"], year=2016)
    assert values(out) == [("a", "x,y", 2016), ("b", '"q"', 2016)]


def test_years_from_file_names(spark, tmp_path):
    for year, text in ((2015, "a,1\n"), (2016, "b,2\nc,3\n")):
        (tmp_path / f"roster1999{year}.csv").write_text("k,v\n" + text)
    (tmp_path / "other.txt").write_text("k,v\nz,9\n")
    out = read_csv_years(spark, str(tmp_path / "roster*.csv"), "k string, v int", expression=r"(\d{4})\.csv")
    assert values(out) == [("a", 1, 2015), ("b", 2, 2016), ("c", 3, 2016)]
    empty = read_csv_years(spark, str(tmp_path / "none*.csv"), "k string, v int")
    assert empty.count() == 0 and empty.columns == ["k", "v", "year"]


def test_append_keeps_what_is_there(rows, spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(rows([("a", 2015)], "k string, year int"), path, ["year"])
    append_table(rows([("b", 2016)], "k string, year int"), path, ["year"])
    assert values(read_tables(spark, path)) == [("a", 2015), ("b", 2016)]
    assert {"year=2015", "year=2016"} <= set(os.listdir(path))


def test_ingest_skips_stored_pages(rows, spark, tmp_path):
    path = str(tmp_path / "weekly")
    schema = "season int, page int, v string"
    assert ingest_new(spark, rows([(2016, 0, "a"), (2016, 0, "b")], schema), path, ["season", "page"]).count() == 2
    again = rows([(2016, 0, "changed"), (2016, 200, "c"), (2017, 0, "d")], schema)
    assert values(ingest_new(spark, again, path, ["season", "page"])) == [
        (2016, 0, "a"),
        (2016, 0, "b"),
        (2016, 200, "c"),
        (2017, 0, "d"),
    ]
    assert ingest_new(spark, again, path, ["season", "page"]).count() == 4


def test_stream_takes_each_page_once(rows, spark, tmp_path):
    source, target, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    schema = "page int, v string"
    first = rows([(0, "a"), (0, "b"), (200, "c")], schema)
    first.coalesce(1).write.mode("append").parquet(source)
    rows([(200, "late copy")], schema).coalesce(1).write.mode("append").parquet(source)
    once = ingest_stream(spark, source, first.schema, target, memory, ["page"])
    assert once.where("page = 0").count() == 2 and once.where("page = 200").count() == 1
    rows([(0, "again"), (400, "d")], schema).coalesce(1).write.mode("append").parquet(source)
    out = ingest_stream(spark, source, first.schema, target, memory, ["page"])
    assert out.count() == 4 and values(out.where("page = 400")) == [(400, "d")]
    assert ingest_stream(spark, source, first.schema, target, memory, ["page"]).count() == 4


PAGE = """<html><!-- <table id="stats"> --><table id="other"><tr><td>no</td></tr></table>
<table class="x" id="stats"><thead><tr><th>Rk</th><th>Player</th><th>Pts</th></tr></thead>
<tr><td>1</td><td data-append-csv="MahoPa00"><a href="/p">Patrick <b>Mahomes</b></a></td><td> 25.1 </td></tr>
<tr><th>Rk</th><th>Player</th><th>Pts</th></tr>
<tr><td>2</td><td data-append-csv="KelcTr00">T. Kelce &amp; co<table><tr><td>inner</td></tr></table></td></tr>
</table><table id="stats2"><tr><td>no</td></tr></table></html>"""


def test_tables_from_pages(rows):
    pages = rows([(7, PAGE), (8, "<p>none</p>"), (9, None)], "page_id long, html string")
    out = page_tables(pages, "stats", ["Rk", "Player", "Pts"])
    assert values(out) == [
        (7, 0, "MahoPa00", "1", "Patrick Mahomes", "25.1", None),
        (7, 1, "KelcTr00", "2", "T. Kelce & co", None, None),
    ]
    assert values(table_counts(pages, "stats")) == [(7, 1), (8, 0), (9, 0)]


def test_plain_pages_need_no_general_parser(monkeypatch):
    """Pages of plain tags are read without it, all pages as it reads them."""
    import random

    from seasonlab.sources import html

    rng = random.Random(4)
    plain = ["<table id='t'>", "<TABLE id=t>", "</table>", "<tr>", "</tr >", "<td>", "<Td colspan=2 m=\"x\">", "<td rowspan='3'>", "<td m>", "<th m=''>", "</td>", "</th>", "<br />"]
    plain += ["<a href='/x?a=1&b=<2>'>", "</a>", "&amp;", "&lt", "x", " ", "\n", "é"]
    odd = ["<!-- <td> -->", "<script>", "</script>", "<", "a<b", "<td m='&lt;'>", "<td/>", "<td m = x>", "<td m=`x`>", "</td x>", "<td m='x'n='y'>", "<td\x0bm=x>", "<!doctype html>", "<td m='"]

    def read(text, by_feed):
        reader = html._TableReader("t", "m", html.TAGS)
        if by_feed:
            reader.feed(text)
            reader.close()
        else:
            reader = html._read_table(text, "t", "m")
            assert html._read_table(text, "t", "", html.ALONE).tables == reader.tables
        return reader.tables, reader.rows

    pages = ["<table id=t><tr>" + "".join(rng.choice(plain if k % 2 else plain + odd) for _ in range(rng.randrange(12))) for k in range(4000)]
    wanted = [read(page, True) for page in pages]
    assert [read(page, False) for page in pages] == wanted
    monkeypatch.setattr(html.HTMLParser, "goahead", None)
    assert [read(page, False) for page in pages[1::2]] == wanted[1::2]


def test_cells_beyond_the_columns_and_spans(rows):
    page = """<table id="t"><tr><th></th><th colspan="2">Games</th></tr><tr><th>Rk</th><th>A</th><th>B</th></tr>
<tr><td rowspan="2">1<td colspan=2>x<td>lost</tr><tr><td>y</td><td>z</td></tr><tr><th>2</th><td>r</td></tr></table><table id="t"></table>"""
    pages = rows([(1, page)], "page_id long, html string")
    assert values(page_tables(pages, "t", ["Rk", "A"])) == [
        (1, 0, None, "1", "x", ["x", "lost"]),
        (1, 1, None, "1", "y", ["z"]),
        (1, 2, None, "2", "r", None),
    ]
    assert values(table_counts(pages, "t")) == [(1, 2)]


def test_ingest_reads_touched_partitions_alone(rows, spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, day int"
    ingest_new(spark, rows([(1, 1), (2, 2), (3, None), (4, 4)], schema), path, ["k"], "day")
    batch = rows([(2, 2), (3, None), (5, 2)], schema)
    plan = touched_partitions(spark.read.schema(schema).parquet(path), batch, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((day" in plan and "DataFilters: []" in plan
    assert values(ingest_new(spark, batch, path, ["k"], "day")) == [(1, 1), (2, 2), (3, None), (4, 4), (5, 2)]


def test_append_keeps_rows_without_a_type(spark, tmp_path):
    from seasonlab.catalog import QUERIES

    events = spark.createDataFrame([(1, 1, 1.0, "view"), (2, 2, 2.0, None), (3, 3, 3.0, "error")], "event_id long, user_id long, value double, event_type string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert values(QUERIES["append_sink"](spark, str(tmp_path)).select("event_id", "event_type")) == [(1, "view"), (2, None), (3, "error")]


def test_pages_without_the_table_and_text_keys(rows):
    pages = rows([("a", "<p>none</p>"), ("b", None)], "page_id string, html string")
    out = page_tables(pages, "stats", ["Rk"])
    assert out.count() == 0 and dict(out.dtypes)["page_id"] == "string"


def test_links_from_pages(rows):
    page = """<a href="/x">X</a> <a class="c" href='/n'>n <b>m</b></a><A HREF=/y></A><a name="z">no</a><a href="/q?a=1&amp;b">&lt;q"""
    pages = rows([(1, page), (2, ""), (3, None)], "page_id long, html string")
    assert values(page_links(pages)) == [(1, 0, "/x", "X"), (1, 1, "/n", "n m"), (1, 2, "/y", ""), (1, 3, "/q?a=1&b", "<q")]


def test_dimension_joins_are_not_hinted():
    folder = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "seasonlab")
    for base, inner, files in os.walk(folder):
        inner[:] = [d for d in inner if d != "llm"]  # has bounded tables that are broadcast
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(base, name), encoding="utf-8").read()
                if name == "joins.py":
                    text = text.replace("F.broadcast(hot)", "", 1)  # a bounded list, four keys per task
                assert "broadcast(" not in text and "localCheckpoint" not in text and "crossJoin" not in text, name


def test_spans_have_the_limits_of_html(spark):
    page = "<table id='t'><tr><td colspan='10000000000'>a</td></tr><tr><td colspan='²' rowspan='99999999999999999999'>b</td><td colspan='0'>c</td></tr><tr><td>d</td></tr></table>"
    out = page_tables(spark.createDataFrame([(1, page)], "page_id int, html string"), "t", ["x", "y"]).orderBy("place").collect()
    assert [(r.x, r.y) for r in out] == [("a", "a"), ("b", "c"), ("b", "d")]
    assert [len(r.extra or []) for r in out] == [998, 0, 0]


def test_derived_tables_have_tasks_in_proportion_to_their_inputs(spark, tmp_path, monkeypatch):
    """Shuffles of a build are cut by the size of its inputs; the session's settings come back."""
    given = str(tmp_path / "given.parquet")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(given)
    monkeypatch.setattr(session, "PART_MB", 1 / 8)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before, seen = [spark.conf.get(n) for n in names], []

    def build():
        seen.extend(spark.conf.get(n) for n in names)
        return spark.read.parquet(given).groupBy("text").count()

    assert session.derived_table(spark, "sized-test", [given], build).count() == 20_000
    assert int(seen[0]) > int(before[0]) and int(seen[0]) >= 8
    assert [spark.conf.get(n) for n in names] == before


def test_derived_tables_are_built_where_no_number_of_tasks_is_set(spark, tmp_path):
    """A session may leave both settings to Spark: its defaults count, and they stay unset."""
    given = str(tmp_path / "given.parquet")
    spark.range(100).write.parquet(given)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before, seen = {n: spark.conf.get(n, None) for n in names}, []

    def build():
        seen.append(spark.conf.get(names[0]))
        return spark.read.parquet(given).groupBy(F.col("id") % 7).count()

    try:
        for n in names:
            spark.conf.unset(n)
        assert session.derived_table(spark, "unset-test", [given], build).count() == 7
        assert seen == ["200"]
        assert [spark.conf.get(n, None) for n in names] == [None, None]
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
