"""Compare registered queries with their SQL on DuckDB, value by value.

Run as a script: python tests/oracle.py [scale folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf: str) -> str | None:
    """None when equal, otherwise what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql()[name]
    kinds = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if ours[1] != theirs[1]:
        only_ours, only_theirs = ours[1] - theirs[1], theirs[1] - ours[1]
        return (
            f"{sum(ours[1].values())} and {sum(theirs[1].values())} rows, {sum(only_ours.values())} differ:\n"
            f"   {ours[0]}\n   spark {list(only_ours)[:2]}\n   sql   {list(only_theirs)[:2]}"
        )
    expected = {n: KINDS.get(t, t) for n, t in df.dtypes}
    wrong = [f"{c}: {expected[c]} and {k}" for c, k in kinds.items() if expected[c] != k]
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from seasonlab.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = connect(folder)
    wanted = sys.argv[2:] or list(queries())
    for query in wanted:
        start = time.monotonic()
        try:
            if query in oracle_sql():
                verdict = compare(spark, con, query, folder) or "equal"
            else:
                verdict = f"no SQL, {queries()[query](spark, folder).count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:900]}"
        print(f"{query}: {verdict} ({time.monotonic() - start:.2f}s)", flush=True)
