"""Compare a registered Spark query with its DuckDB twin: row count, column
names and an order-insensitive multiset of values (columns sorted by name)."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rows_of(d_cols, rel.fetchall())
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols),
           "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    cs, cd = collections.Counter(s_rows), collections.Counter(d_rows)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_oracle"] = list((cd - cs).elements())[:3]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out


if __name__ == "__main__":
    import sys
    import time
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tidemark.session import ensure_checkpoint_root, local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    ensure_checkpoint_root(spark)
    con = duck(sf)
    sql = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            r = compare(spark, con, fn, sql[name], sf)
        except Exception as e:  # report and go on
            r = {"ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        brief = {k: v for k, v in r.items() if k not in ("spark_cols", "oracle_cols") or not r.get("columns_match")}
        print(f"{name:32s} {time.time() - t:6.2f}s {brief}", flush=True)
    print("FAILED", bad)
