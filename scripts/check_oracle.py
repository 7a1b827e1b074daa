"""Run registered queries on Spark and their oracle SQL on DuckDB over the same Parquet; compare.

usage: python scripts/check_oracle.py [--sf DIR] [name ...]
Prints one line per query: OK / DIFF / ERR / ROWS (no oracle) with row counts.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from chronoframe.plans.catalog import TABLES, load_all  # noqa: E402
from chronoframe.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bool,)):
        return bool(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(records, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    cat = load_all()
    names = [n for n in cat if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for n in names:
        q = cat[n]
        t0 = time.time()
        try:
            sdf = q.build(spark, args.sf)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sorted(sdf.columns)
            stypes = dict(sdf.dtypes)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {n}: spark {type(e).__name__}: {str(e)[:600]}")
            traceback.print_exc(limit=3)
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"ROWS {n}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(q.sql)
            dcols_raw = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            drecs = [dict(zip(dcols_raw, r)) for r in res.fetchall()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {n}: duckdb {type(e).__name__}: {str(e)[:600]}")
            continue
        dcols = sorted(dcols_raw)
        if scols != dcols:
            bad += 1
            print(f"DIFF {n}: columns spark={scols} duck={dcols}")
            continue
        a, b = rows_of(srows, scols), rows_of(drecs, dcols)
        if a == b:
            tinfo = ", ".join(f"{c}:{stypes[c]}/{dtypes[c]}" for c in scols)
            print(f"OK   {n}: {len(a)} rows ({ts:.1f}s)  [{tinfo}]")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            diff_a = [r for r in a if r not in sb][:3]
            diff_b = [r for r in b if r not in sa][:3]
            print(f"DIFF {n}: spark {len(a)} rows, duck {len(b)} rows; cols {scols}\n   spark-only {diff_a}\n   duck-only  {diff_b}")
    print(f"{len(names) - bad}/{len(names)} passed")
    spark.stop()


if __name__ == "__main__":
    pd.set_option("display.width", 200)
    main()
