"""Queries that write tables and read them back, and rows out of web pages and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.catalog.registry import query
from seasonlab.catalog.views import table
from seasonlab.session import new_path
from seasonlab.streaming import ingest_stream
from seasonlab.operators import key_violations
from seasonlab.sources import (
    CheckFailed,
    append_table,
    complete,
    ingest_new,
    missing_ranges,
    page_links,
    page_tables,
    publish,
    read_csv,
    read_csv_years,
    read_current,
    read_tables,
    rows_in_ranges,
    table_counts,
    write_csv,
)

ORDER_SCHEMA = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"


@query("SELECT o_orderkey, o_totalprice, o_orderpriority, 1998 AS year FROM orders")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "orders-csv")
    write_csv(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path)
    return read_csv(spark, path, ORDER_SCHEMA, ["o_orderkey", "o_totalprice", "o_orderpriority"], year=1998)


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INT) AS year FROM orders"
)
def csv_glob_year(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV per season, found by pattern; the season is in the path only."""
    path = new_path(spark, "orders-by-year")
    orders = table(spark, sf, "orders")
    named = orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("file"),
    )
    write_csv(named, path, ["file"])
    return read_csv_years(spark, f"{path}/file=orders_*.csv", ORDER_SCHEMA)


@query("SELECT event_id, user_id, value, event_type FROM events")
def append_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to a partitioned table."""
    path = new_path(spark, "events-appended")
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    viewed = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    append_table(events.where(viewed), path, ["event_type"])
    append_table(events.where(~viewed), path, ["event_type"])
    return read_tables(spark, path)


def _batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Events in two batches that overlap by ten days."""
    day = F.dayofmonth("ts")
    events = table(spark, sf, "events")
    return [events.where(part).select("event_id", "user_id", "value", day.alias("day")) for part in (day <= 20, day >= 10)]


@query("SELECT event_id, user_id, value FROM events")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping batches; rows of the second that are stored already are skipped."""
    path = new_path(spark, "events-ingested")
    for batch in _batches(spark, sf):
        out = ingest_new(spark, batch, path, ["event_id"], "day")
    return out.select("event_id", "user_id", "value")


@query("SELECT event_id, user_id, value FROM events")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same batches as files that a stream takes in, each run what is new."""
    folder = new_path(spark, "events-stream")
    for batch in _batches(spark, sf):
        append_table(batch, f"{folder}/arrived")
        out = ingest_stream(spark, f"{folder}/arrived", batch.schema, f"{folder}/stored", f"{folder}/checkpoint", ["event_id"], "day")
    return out.select("event_id", "user_id", "value")


@query("SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN value * 2e0 ELSE value END AS value, event_type FROM events")
def published_swap(spark: SparkSession, sf: str) -> DataFrame:
    """A table checked before it counts, a partition replaced by what is read from it, and
    a write that fails its check and changes nothing."""
    path = new_path(spark, "events-published")
    unique = [("repeated ids", lambda rows: key_violations(rows, ["event_id"]))]
    publish(table(spark, sf, "events").select("event_id", "user_id", "value", "event_type"), path, unique, ["event_type"])
    clicks = read_current(spark, path).where("event_type = 'click'")
    publish(clicks.withColumn("value", F.col("value") * 2), path, unique, ["event_type"], replace="partitions")
    now = read_current(spark, path)
    try:
        publish(now.unionByName(now), path, unique, ["event_type"])
    except CheckFailed:
        pass
    return read_current(spark, path)


def _paged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as rows of four sources by offset, a store of them with holes, and what is expected
    of each source; a fifth one has not been read at all."""
    events = table(spark, sf, "events").select((F.col("event_id") % 4).alias("shard"), F.floor(F.col("event_id") / 4).alias("place"), "event_id", "value")
    hole = (F.col("event_id") % 97 < 3) | ((F.col("shard") == 2) & F.col("place").between(1000, 1400)) | (F.col("shard") == 3)
    expected = events.groupBy("shard").agg(F.min("place").alias("first"), (F.max("place") + 5).alias("last"))
    return events, events.where(~hole), expected


@query(
    """WITH paged AS (SELECT event_id % 4 AS shard, CAST(floor(event_id / 4e0) AS BIGINT) AS place, event_id FROM events),
have AS (SELECT DISTINCT shard, place FROM paged WHERE NOT (event_id % 97 < 3 OR (shard = 2 AND place BETWEEN 1000 AND 1400) OR shard = 3)),
fences AS (SELECT shard, place FROM have UNION ALL SELECT shard, min(place) - 1 FROM paged GROUP BY 1 UNION ALL SELECT shard, max(place) + 6 FROM paged GROUP BY 1)
SELECT shard, place + 1 AS start, next - 1 AS "end" FROM (SELECT *, lead(place) OVER (PARTITION BY shard ORDER BY place) AS next FROM fences) WHERE next > place + 1"""
)
def missing_offsets(spark: SparkSession, sf: str) -> DataFrame:
    _, stored, expected = _paged(spark, sf)
    return missing_ranges(stored, expected, ["shard"], "place", block=512)


@query("SELECT event_id % 4 AS shard, CAST(floor(event_id / 4e0) AS BIGINT) AS place, event_id, value FROM events")
def completed_store(spark: SparkSession, sf: str) -> DataFrame:
    """A store with holes, to which a run adds only what is missing, and a second run nothing."""
    source, stored, expected = _paged(spark, sf)
    path = new_path(spark, "events-by-offset")
    publish(stored, path)
    for _ in range(2):
        now = read_current(spark, path)
        more = complete(now, expected, ["shard"], "place", lambda ranges: rows_in_ranges(source, ranges, ["shard"], "place"))
        publish(more, path, replace="none")
    return read_current(spark, path)


DECODED = "replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(
    f"""SELECT page_id, CAST(place - 2 AS INT) AS place, {DECODED.format("split_part(split_part(part, 'href=\"', 2), '\"', 1)")} AS href,
  {DECODED.format("substr(split_part(part, '</a>', 1), strpos(part, '>') + 1)")} AS label
FROM (SELECT page_id, parts[place] AS part, place FROM (SELECT page_id, parts, unnest(generate_series(2, len(parts))) AS place
  FROM (SELECT page_id, string_split(html, '<a ') AS parts FROM pages)))"""
)
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return page_links(table(spark, sf, "pages"))


TABLE_COLUMNS = ["Rk", "Customer", "Total", "Priority"]


def order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A web page per order: its own row, a repeated header, and its customer's row."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # reading pages is slow per row
    orders = table(spark, sf, "orders").repartition(tasks, "o_orderkey")
    head = "<tr>" + "".join(f"<th>{c}</th>" for c in TABLE_COLUMNS) + "</tr>"
    customer, price = F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")
    html = F.concat(
        F.lit(f"<html><table id='nav'><tr><td>menu</td></tr></table><table id='stats'><tr><th colspan=4>Orders</th></tr>{head}<tr><td>1</td><td data-append-csv='c"),
        customer,
        F.lit("'><a href='/c'>Customer &amp; "),
        customer,
        F.lit("</a></td><td> "),
        price,
        F.lit(f"</td><td>x &lt; y</td></tr>{head}<tr><td>2</td><td data-append-csv='s"),
        "o_orderstatus",
        F.lit("'>second</td><td>"),
        price,
        F.lit("</td><td>"),
        "o_orderpriority",
        F.lit("</td><td colspan=2>more</td></tr></table></html>"),
    )
    return orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


@query(
    """SELECT o_orderkey AS page_id, 0 AS place, concat('c', o_custkey) AS ref, '1' AS "Rk", concat('Customer & ', o_custkey) AS "Customer",
  o_totalprice AS "Total", 'x < y' AS "Priority", 0 AS extra FROM orders
UNION ALL SELECT o_orderkey, 1, concat('s', o_orderstatus), '2', 'second', o_totalprice, o_orderpriority, 2 FROM orders"""
)
def html_tables(spark: SparkSession, sf: str) -> DataFrame:
    rows = page_tables(order_pages(spark, sf), "stats", TABLE_COLUMNS)
    return rows.withColumns({"Total": F.col("Total").cast("double"), "extra": F.coalesce(F.size("extra"), F.lit(0))})


@query("SELECT o_orderkey AS page_id, 1 AS n FROM orders")
def html_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table_counts(order_pages(spark, sf), "stats")


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CAST(to_json({'event_id': event_id, 'k': CAST(json_extract(props, '$.k') AS BIGINT)}) AS VARCHAR) AS record FROM events"""
)
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    rows = rows.select("event_id", F.col("p.k").alias("k"))
    return rows.select("event_id", "k", F.to_json(F.struct("event_id", "k")).alias("record"))
