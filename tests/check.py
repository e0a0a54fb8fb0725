"""Compare registered queries with their oracle SQL: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import collections
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return f"{type(value).__name__}:{value!r}"


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    return bag([d[0] for d in result.description], result.fetchall())


def compare(spark, folder: str, name: str):
    """(ok, message) for one query."""
    from tremorlake.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return False, "the plan has a cross or nested-loop join"
    names, rows = bag(df.columns, df.collect())
    if name not in ORACLES:
        return True, f"rows only: {sum(rows.values())}"
    want_names, want = oracle_rows(folder, ORACLES[name])
    if names != want_names:
        return False, f"columns {names} != {want_names}"
    if rows != want:
        left, right = list((rows - want).items()), list((want - rows).items())
        return False, f"{sum(rows.values())} rows, {len(left)} only in Spark {left[:2]}, {len(right)} only in SQL {right[:2]}"
    return True, f"{sum(rows.values())} rows equal"


def main() -> int:
    from tremorlake.queries import QUERIES, load_all
    from tremorlake.session import local_session

    load_all()
    args = sys.argv[1:]
    scale = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args or list(QUERIES):
        start = time.time()
        try:
            ok, message = compare(spark, f"/root/testdata/{scale}", name)
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{bad} failed of {len(args or QUERIES)}")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
