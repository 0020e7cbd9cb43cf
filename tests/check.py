"""Run registered queries next to their SQL in DuckDB and compare the rows.

    python -m tests.check [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

from catalog.derive import GIVEN

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in GIVEN:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = normal([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    left, right = set(map(repr, mine[1])), set(map(repr, theirs[1]))
    return (
        f"rows {len(mine[1])} vs {len(theirs[1])}; columns {mine[0]}; only spark {sorted(left - right)[:3]}; "
        f"only sql {sorted(right - left)[:3]}"
    )


def main() -> int:
    from catalog.queries import ORACLES, QUERIES
    from linkloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else DEFAULT_DIR
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # show every failure of the run, not only the first
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        rows = ""
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {rows}{problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
