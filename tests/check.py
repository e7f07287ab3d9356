"""Side-by-side run of registered queries and their oracle SQL (the tests and hand runs share it)."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "<nan>" if math.isnan(v) else (str(int(v)) if v == int(v) else f"{v:.6f}")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name, fn, sql, con=None):
    """(ok, message, seconds)"""
    start = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    spent = time.time() - start
    if sql is None:
        return True, f"rows={len(got)} (no oracle)", spent
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}", spent
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return False, (f"rows spark={len(got)} oracle={len(want)}; only spark {len(a)}: {sorted(a)[:2]}; "
                       f"only oracle {len(b)}: {sorted(b)[:2]}"), spent
    return True, f"rows={len(got)}", spent


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from rosterline.plans import registry
    from rosterline.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    registry.load()
    spark = local_session()
    con = duck(sf)
    wanted = sys.argv[1:]
    bad = 0
    for name, fn in registry.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, msg, sec = compare(spark, sf, name, fn, registry.ORACLES.get(name), con)
        except Exception as exc:  # keep going: the list of failures is the point
            ok, msg, sec = False, f"{type(exc).__name__}: {str(exc)[:900]}", 0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {sec:.1f}s {msg}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
