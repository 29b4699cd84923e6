"""Run named queries against their SQL on DuckDB and compare names, row counts and values.

Arguments: a table folder, query names or prefixes ending in *, and -name to leave one out.
"""

from __future__ import annotations

import datetime
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from larkframe.tables import NAMES  # noqa: E402


def connect(path: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return ("f", 0.0 if v == 0 else float(f"{v:.12g}"))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, datetime.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return (type(v).__name__, str(v))


def shape(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)


def check(spark, con, name, fn, sql, path):
    """None when equal, otherwise a text that says what differs."""
    df = fn(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if bad in plan:
            return f"plan has {bad}"
    got = shape(df.columns, [tuple(r) for r in df.collect()])
    if len(set(df.columns)) != len(df.columns):
        return f"duplicate column names {df.columns}"
    if sql is None:
        return None if got[1] else "no rows"
    rel = con.execute(sql)
    want = shape([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} want {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} want {len(want[1])}; first {got[1][:2]} want {want[1][:2]}"
    if not got[1]:
        return "both empty"
    for g, w in zip(got[1], want[1]):
        if g != w:
            bad = sum(a != b for a, b in zip(got[1], want[1]))
            return f"{bad} of {len(got[1])} rows differ, first {g} want {w} columns {got[0]}"
    return None


def main():
    import __spark_entry__ as e
    from larkframe.session import local_session

    path = "/root/testdata/sf0.01"
    skip = {a[1:] for a in sys.argv[1:] if a.startswith("-")}
    args = [a for a in sys.argv[1:] if not a.startswith("-")]
    if args and args[0].startswith("/"):
        path = args.pop(0)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    qs, oracles = e.queries(), e.oracle_sql()
    names = [n for n in qs if n not in skip]
    names = [n for n in names if not args or n in args or any(a.endswith("*") and n.startswith(a[:-1]) for a in args)]
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            msg = check(spark, con, n, qs[n], oracles.get(n), path)
        except Exception as ex:  # report and go on
            msg = "ERROR " + "".join(traceback.format_exception_only(ex))[:600]
        dt = time.time() - t0
        if msg or dt > 8:
            bad += bool(msg)
            print(f"{n} [{dt:.1f}s] {msg or 'slow'}", flush=True)
    print(f"{len(names)} queries, {bad} bad", flush=True)


if __name__ == "__main__":
    main()
