"""Compare a registered Spark query with its DuckDB oracle.

Same check as the driver's: column names, row count, and an
order-insensitive comparison of all values. Usable from pytest and as a
script: ``python -m tests.oracle_compare /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if os.environ.get("COMPARE_EXACT") else repr(round(v, 9)))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if os.environ.get("COMPARE_EXACT") else repr(round(float(v), 9)))
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if hasattr(v, "item"):
        return _norm(v.item())
    return (4, str(v))


def compare(spark, key: str, sf_dir: str, query=None, sql=None, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    query = query or queries()[key]
    sql = sql or oracle_sql().get(key)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = [tuple(r) for r in rel.fetchall()]
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"schema: spark={s_cols} oracle={d_cols}"
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted(tuple(_norm(r[i]) for i in order) for r in s_rows)
    d_norm = sorted(tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    if len(s_norm) != len(d_norm):
        out["status"] = "rowcount"
    elif s_norm != d_norm:
        diffs = [(a, b) for a, b in zip(s_norm, d_norm) if a != b]
        names = [s_cols[i] for i in order]
        bad_cols = sorted({names[j] for a, b in diffs for j in range(len(a)) if a[j] != b[j]})
        out["status"] = f"values: {len(diffs)} rows differ, columns {bad_cols}"
        out["example"] = [str(diffs[0][0]), str(diffs[0][1])]
    else:
        out["status"] = "match"
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from wardwatch.session import build_session
    from __spark_entry__ import queries
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(queries())
    mem = os.environ.get("COMPARE_DRIVER_MEMORY", "8g")
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": mem} if mem else None)
    con = duck(sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf, con=con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
