"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows exactly."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if sum(got.values()) else "no rows"
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        return (f"{sum(got.values())} rows vs {sum(want.values())}; only spark: {list((got - want).items())[:3]}; "
                f"only sql: {list((want - got).items())[:3]}")
    if not got:
        return "no rows on both sides"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from riskspark.sources.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), duck(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for name in queries:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, name, queries[name], oracles.get(name), sf)
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        if problem:
            bad += 1
        note = "" if name in oracles else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{note} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
