"""Runs the registered queries next to their SQL and compares all rows.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, Decimal):
        return f"decimal {v}"
    if isinstance(v, datetime):
        return v.isoformat()
    return repr(v)


def rows(names: list[str], data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str | None:
    """None when columns and rows agree, otherwise what differs."""
    found = con.sql(sql)
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {sorted(df.columns)} != {sorted(found.columns)}"
    mine, theirs = rows(df.columns, df.collect()), rows(found.columns, found.fetchall())
    if mine == theirs:
        return None
    return (
        f"rows {mine.total()} vs {theirs.total()}; only ours {list((mine - theirs).items())[:2]}; "
        f"only theirs {list((theirs - mine).items())[:2]}"
    )


if __name__ == "__main__":
    from tests.sessions import local_session
    from workload import ORACLES, QUERIES

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connection(directory)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, directory)
            told = difference(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as failure:  # noqa: BLE001
            told = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += told is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {told or 'equal'}", flush=True)
    print("not equal:", bad)
