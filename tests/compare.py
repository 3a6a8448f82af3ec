"""Run a registered query beside its oracle and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


def run(spark, con, name: str, sf: str, inspect=None):
    """(matches, message)."""
    t = time.time()
    df = entry_module.queries()[name](spark, sf)
    if inspect:
        inspect(df)
    columns = sorted(df.columns)
    got = ordered(df.select(columns).collect())
    took = time.time() - t
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return None, f"rows only: {len(got)} rows, {took:.1f}s"
    t = time.time()
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    rows = rel.fetchall()
    duck_took = time.time() - t
    if sorted(names) != columns:
        return False, f"columns {columns} vs {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = ordered(tuple(r[i] for i in at) for r in rows)
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return False, f"{len(got)} vs {len(want)} rows; first differences {str(bad)[:1500]}"
    return True, f"{len(got)} rows, spark {took:.1f}s, duckdb {duck_took:.1f}s"


if __name__ == "__main__":
    from corpusloom.session import build_session

    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    con = duck(sf)
    failed = []
    for name in sys.argv[2:] or sorted(entry_module.queries()):
        try:
            ok, text = run(spark, con, name, sf)
        except Exception as e:
            ok, text = False, f"{type(e).__name__}: {str(e)[:1200]}"
        print({True: "ok  ", False: "FAIL", None: "rows"}[ok], name, text, flush=True)
        failed += [name] if ok is False else []
    print("failed:", failed)
