"""Run registered queries against DuckDB on the same files.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from checks.oracles import all_oracles
from checks.queries import all_queries
from stockwell.session import build_session


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


def compare(spark, sf_dir: str, name: str) -> str:
    """Empty text when equal, else what differs."""
    df = all_queries()[name](spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = all_oracles().get(name)
    if sql is None:
        return ""
    columns, rows = oracle_rows(sf_dir, sql)
    theirs = _rows(columns, rows)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if differing:
        return f"{len(differing)} of {len(mine)} rows differ, e.g. {sorted(columns)} {differing[:3]}"
    types = [(a, b) for a, b in zip(mine, theirs) if [type(x) for x in a] != [type(x) for x in b]]
    if types:
        return f"types differ, e.g. {sorted(columns)} {types[0]}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("checks", "local[8]", **local)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, sf_dir, name)
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:32s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
