"""Run registered queries against their SQL counterpart in DuckDB and compare values.

usage: check_queries.py SF_DIR [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from panelspark.plans import load_all
from panelspark.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, q, sf_dir):
    t0 = time.time()
    df = q.run(spark, sf_dir)
    got = [tuple(x) for x in df.collect()]
    t1 = time.time()
    if q.sql is None:
        return f"rows-only {len(got)}", t1 - t0, 0.0
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    if sorted(df.columns) != sorted(names):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(names)}", t1 - t0, t2 - t1
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if not a and not b:
        return "EMPTY", t1 - t0, t2 - t1
    if a == b:
        return "ok", t1 - t0, t2 - t1
    close = len(a) == len(b)
    shown = []
    bad = 0
    for x, y in zip(a, b):
        if x != y:
            bad += 1
            if len(shown) < 2:
                diff = [(n, p, s) for n, p, s in zip(sorted(names), x, y) if p != s]
                shown.append((x[:3], diff[:4]))
    return f"MISMATCH rows {len(a)}/{len(b)} differing {bad} {shown if close else (a[:2], b[:2])}", t1 - t0, t2 - t1


def main():
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session("check", cores=8)
    con = connect(sf_dir)
    failed = 0
    for name, q in load_all().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            verdict, a, b = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and go on with the next query
            verdict, a, b = f"ERROR {type(e).__name__} {str(e)[:600]}", 0, 0
        failed += not (verdict == "ok" or verdict.startswith("rows-only"))
        print(f"{name:42s} spark {a:6.2f}s sql {b:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
