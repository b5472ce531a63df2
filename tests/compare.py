"""Runs registered queries next to their SQL in DuckDB.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, fn, sql):
    """None if equal, else what differs."""
    df = fn(spark, sf)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if mine else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = rows_of(columns, cursor.fetchall())
    if not mine:
        return "no rows"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    off = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if off:
        return f"{len(off)} of {len(mine)} rows differ ({sorted(columns)}):\n   {str(off[0][0])[:600]}\n   {str(off[0][1])[:600]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from polyspark.queries import QUERIES
    from polyspark.session import local_session

    args = sys.argv[1:]
    sf = f"/root/testdata/{args[0] if args else 'sf0.001'}"
    names = args[1:] or list(QUERIES)
    names = [q for n in names for q in ([n] if n in QUERIES else [k for k in QUERIES if QUERIES[k][0].__module__.endswith("." + n)])]
    spark, con = local_session(8), connection(sf)
    bad = 0
    for name in names:
        began = time.time()
        try:
            problem = compare(spark, con, sf, *QUERIES[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - began:6.1f}s {'ok' if problem is None else problem}", flush=True)
    print("failed:", bad, "of", len(names))
