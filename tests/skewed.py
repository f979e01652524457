"""Copies of the tables in which one key holds a third of the rows."""

from __future__ import annotations

import os
import shutil

import duckdb

HOT = {
    "lineitem": "* REPLACE (CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN l_suppkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END AS user_id,"
    " CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type)",
}


def write_skewed(source: str, target: str) -> str:
    os.makedirs(target, exist_ok=True)
    for file in os.listdir(source):
        name = file.removesuffix(".parquet")
        if name in HOT:
            duckdb.sql(f"COPY (SELECT {HOT[name]} FROM '{source}/{file}') TO '{target}/{file}' (FORMAT parquet)")
        else:
            shutil.copy(f"{source}/{file}", f"{target}/{file}")
    return target
