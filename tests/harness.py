"""Side-by-side check of a Spark query against its DuckDB SQL twin (row count, column names, values).

Run directly for a report: ``python tests/harness.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["check"] = "rows-only"
        return res
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    res["values_match"] = res["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    res["check"] = "ok" if res["values_match"] and len(s_rows) == len(d_rows) else "MISMATCH"
    if res["check"] != "ok":
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = diff
    return res


if __name__ == "__main__":
    from scorebook.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "check": "ERROR", "error": repr(exc)[:600]}
        bad += r["check"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("failures:", bad)
