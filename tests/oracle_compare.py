"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison is order-insensitive: columns sorted by name, rows as a multiset
of normalised values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date, dt.time)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    body = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, body


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None):
    from __spark_entry__ import oracle_sql, queries

    qs, sql = queries(), oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
            res = {"rows": len(s_rows), "spark_s": round(time.time() - t0, 2)}
            if name in sql:
                cur = con.execute(sql[name])
                d_cols = [c[0] for c in cur.description]
                d_rows = cur.fetchall()
                a, b = _canon(s_cols, s_rows), _canon(d_cols, d_rows)
                res["oracle_rows"] = len(d_rows)
                res["cols_match"] = a[0] == b[0]
                res["match"] = a == b
                if not res["match"]:
                    res["spark_cols"], res["oracle_cols"] = a[0], b[0]
                    diff = [r for r in a[1][:2000] if r not in set(b[1])][:3]
                    res["sample_spark_only"] = diff
            out[name] = res
        except Exception as exc:  # noqa: BLE001
            out[name] = {"error": f"{type(exc).__name__}: {str(exc)[:400]}"}
    return out


if __name__ == "__main__":
    from tidewater.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, v in res.items():
        ok = v.get("match", "error" not in v)
        bad += not ok
        print(("OK  " if ok else "BAD ") + k, v)
    print(f"{len(res) - bad}/{len(res)} match")
