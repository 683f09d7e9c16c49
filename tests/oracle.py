"""Run registered queries beside their SQL twins: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import threading
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


def kind(v):
    return "none" if v is None else type(v).__name__


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    sn, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t_spark = time.time() - t
    if sql is None:
        return True, f"rows-only {len(sr)} rows {t_spark:.1f}s"
    t = time.time()
    cur = con.execute(sql)
    dn, dr = rows_of([d[0] for d in cur.description], cur.fetchall())
    note = f"{len(sr)} rows spark {t_spark:.1f}s duck {time.time() - t:.1f}s"
    if sn != dn:
        return False, f"columns {sn} != {dn}"
    if len(sr) != len(dr):
        return False, f"rows {len(sr)} != {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b or [kind(x) for x in a] != [kind(x) for x in b]:
            return False, f"{note}\n   spark {str(a)[:600]}\n   duck  {str(b)[:600]}"
    return True, note + ("" if sr else "  EMPTY")


def main():
    from chatloom.catalog import load
    from chatloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    queries, oracles = load()
    names = [n for n in queries if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    spark, sf_dir = local_session("8"), f"{DATA}/sf{sf}"
    con = duck(sf_dir)
    bad = 0
    for n in names:
        timer = threading.Timer(float(os.environ.get("QUERY_LIMIT", "120")), spark.sparkContext.cancelAllJobs)
        timer.start()
        try:
            ok, note = compare(spark, con, n, queries[n], oracles.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        timer.cancel()
        bad += not ok
        print(("ok   " if ok else "FAIL ") + n, note, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
