"""Run a registered query in Spark and its SQL in DuckDB, compare results.

Comparison as the driver does it: columns sorted by name, row count,
order-insensitive hash of the values. Doubles are rounded to 9 significant
digits before hashing so summation order does not matter.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {str(k): _norm(x) for k, x in sorted(v.items())}
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _digest(rows):
    hs = sorted(hashlib.sha1(json.dumps(r, default=str).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from lectern.plans.registry import ORACLE, QUERIES

    con = con or duckdb_con(sf_dir)
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 3)}
    if key not in ORACLE:
        out["status"] = "rows-only"
        return out
    t0 = time.time()
    rel = con.sql(ORACLE[key])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["duck_sec"] = round(time.time() - t0, 3)
    out["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = [[_norm(r[i]) for i in si] for r in s_rows]
    d_norm = [[_norm(r[i]) for i in di] for r in d_rows]
    if len(s_norm) != len(d_norm):
        out["status"] = "row count differs"
    elif _digest(s_norm) != _digest(d_norm):
        out["status"] = "values differ"
        s_set = sorted(json.dumps(r, default=str) for r in s_norm)
        d_set = sorted(json.dumps(r, default=str) for r in d_norm)
        only_s = [r for r in s_set if r not in set(d_set)][:3]
        only_d = [r for r in d_set if r not in set(s_set)][:3]
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    else:
        out["status"] = "match"
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    out["types"] = {c: (s_types[c], d_types[c]) for c in order}
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from lectern.plans.registry import QUERIES, load_all
    from lectern.session import get_session

    load_all()
    spark = get_session("local[8]")
    con = duckdb_con(args.sf_dir)
    keys = args.keys or sorted(QUERIES)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, args.sf_dir, con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    print(f"# {len(keys) - bad}/{len(keys)} ok", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
