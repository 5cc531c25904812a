"""Compare registered Spark queries with their DuckDB oracles (row count, columns, values).

CLI: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v  # exact: both engines must produce the same double
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _canon(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def _rows(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 3), "cols_match": sorted(s_cols) == sorted(d_cols)}
    res["values_match"] = res["cols_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    elif not res["values_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        res["spark_only"] = [r for r in a if r not in b][:3]
        res["oracle_only"] = [r for r in b if r not in a][:3]
    res["ok"] = res["values_match"] and res["spark_rows"] == res["oracle_rows"]
    return res


def main(argv: list[str]) -> int:
    from viewsift.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session()
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(qs):
        if k not in oracles:
            t0 = time.time()
            n = qs[k](spark, sf_dir).count()
            print({"key": k, "rows_only": n, "spark_sec": round(time.time() - t0, 3)})
            continue
        try:
            r = compare(spark, sf_dir, k, qs[k], oracles[k], con)
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "error": repr(e)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
