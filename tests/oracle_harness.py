"""Compare a registered Spark query with its DuckDB twin the way the driver does:
row count, column names (sorted), and an order-insensitive comparison of all values.

Run all: ``python tests/oracle_harness.py [sf_dir] [key ...]``.
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
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def compare(spark, sf_dir: str, key: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    scols, srows_n = normalise(sdf.columns, srows)
    if sql is None:
        return {"key": key, "rows": len(srows), "oracle": None, "spark_sec": round(t_spark, 2)}
    con = duck(sf_dir)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    dcols_n, drows_n = normalise(dcols, drows)
    res = {"key": key, "rows": len(srows), "oracle_rows": len(drows), "spark_sec": round(t_spark, 2),
           "schema_ok": scols == dcols_n, "values_ok": srows_n == drows_n}
    if not res["schema_ok"]:
        res["spark_cols"], res["oracle_cols"] = scols, dcols_n
    if res["schema_ok"] and not res["values_ok"]:
        a, b = set(srows_n), set(drows_n)
        res["only_spark"] = sorted(a - b, key=str)[:3]
        res["only_oracle"] = sorted(b - a, key=str)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from daybook.session import build_session
    spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or qs:
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k))
        except Exception as e:  # report and continue
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("oracle") is None and "error" not in r and "schema_ok" not in r or (r.get("schema_ok") and r.get("values_ok"))
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} bad of {len(keys or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
