"""Run registered queries beside their SQL oracle and compare whole results.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, f"{float(v):.6f}".replace("-0.000000", "0.000000"))
    return (3, str(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def kinds(columns, data):
    out = {}
    for i, c in enumerate(columns):
        ts = {type(r[i]).__name__ for r in data if r[i] is not None}
        out[c] = ts
    return out


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got), "rows-only"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return len(got), f"COLUMNS {sorted(df.columns)} vs {sorted(cols)}"
    if len(got) != len(want):
        return len(got), f"ROWS {len(got)} vs {len(want)}"
    kg, kw = kinds(df.columns, got), kinds(cols, want)
    bad = {c: (kg[c], kw[c]) for c in kg if kg[c] and kw[c] and kg[c] != kw[c]}
    a, b = rows(df.columns, got), rows(cols, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return len(got), f"VALUES {len(diff)} rows, {sorted(cols)} first {diff[0]}"
    if bad:
        return len(got), f"TYPES {bad}"
    return len(got), "ok"


def main():
    from sitegauge.plans import ORACLES, QUERIES
    from sitegauge.session import build_session
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf = args.pop(0)
    spark = build_session("local[8]")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            n, verdict = compare(spark, con, fn, ORACLES.get(name), sf)
        except Exception as exc:  # report and go on
            n, verdict = -1, f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        flag = "" if verdict in ("ok", "rows-only") else "  <<<<"
        failed += bool(flag)
        print(f"{name:38s} {n:8d} {time.time() - t:6.2f}s {verdict[:1200]}{flag}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
