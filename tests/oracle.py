"""Compare queries with their oracle SQL in DuckDB, as multisets of rows.

Run as a script: ``python -m tests.oracle [sf] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} but oracle {sorted(names)}"
    theirs = rows_of(names, expected.fetchall())
    mine = rows_of(frame.columns, frame.collect())
    if mine == theirs:
        return None if mine else "both are empty"
    extra, missing = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows but oracle {sum(theirs.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )


def main(sf: str, names: list[str]) -> int:
    from harness.registry import ORACLES, QUERIES
    from millrace.session import local_session

    spark = local_session(8)
    sf_dir = f"/root/testdata/{sf}"
    con = connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(frame, con, ORACLES[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main((sys.argv[1:] or ["sf0.001"])[0], sys.argv[2:]) else 0)
