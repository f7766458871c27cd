"""Runs registered queries on Spark and DuckDB side by side and compares rows.

    python tools/check.py --sf 0.01 [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from clinisift.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads=8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in v.items()) + "}"
    return f"{type(v).__name__}:{v}"


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    spent = time.time() - t
    if sql is None:
        return "rows-only", len(got), spent, ""
    t = time.time()
    cur = con.execute(sql)
    want = cur.fetchall()
    dt = time.time() - t
    cols = [c[0] for c in cur.description]
    a, ca = rows_of(df.columns, got)
    b, cb = rows_of(cols, want)
    if ca != cb:
        return "SCHEMA", len(got), spent, f"{ca} != {cb}"
    if a != b:
        sa, sb = set(a), set(b)
        return "DIFF", len(got), spent, (f"{len(a)} vs {len(b)} rows; spark-only {len(sa - sb)}: {sorted(sa - sb)[:2]}; "
                                         f"sql-only {len(sb - sa)}: {sorted(sb - sa)[:2]}")[:1600]
    return "ok", len(got), spent, f"sql {dt:.1f}s"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--module")
    ap.add_argument("--explain", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "10g",
        "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1",
        "spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("OFF")
    import logging
    logging.disable(logging.ERROR)
    from driver_queries import ALL_QUERIES, ALL_SQL
    names = a.names or list(ALL_QUERIES)
    if a.module:
        from importlib import import_module
        names = list(import_module(f"driver_queries.{a.module}").QUERIES)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            if a.explain:
                ALL_QUERIES[n](spark, sf_dir).explain("formatted")
                continue
            st, rows, spent, note = compare(spark, con, n, ALL_QUERIES[n], ALL_SQL.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            st, rows, spent, note = "ERROR", 0, 0.0, str(e)[:600]
        bad += st not in ("ok", "rows-only")
        print(f"{st:9} {n:32} rows={rows:<8} {spent:6.2f}s {note}", flush=True)
    print("bad:", bad)
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
