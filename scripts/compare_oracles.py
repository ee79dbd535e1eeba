"""Run registered queries in Spark and their DuckDB oracles; report mismatches.

    python scripts/compare_oracles.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ferrule.plans.registry import all_queries  # noqa: E402
from ferrule.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return "f" + repr(v)  # strict: the driver hashes exact values
    if isinstance(v, decimal.Decimal):
        return "f" + repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{args.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs = all_queries()
    names = args.names or sorted(qs)
    bad = 0
    for name in names:
        q = qs[name]
        t0 = time.time()
        try:
            sdf = q.build(spark, args.sf)
            srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.oracle:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.oracle)
            dcols = [d[0] for d in res.description]
            drows = [tuple(norm(x) for x in r) for r in res.fetchall()]
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        order = [dcols.index(c) for c in scols]
        drows = [tuple(r[i] for i in order) for r in drows]
        s_sorted, d_sorted = sorted(srows, key=key), sorted(drows, key=key)
        if s_sorted == d_sorted:
            print(f"ok   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            sset, dset = set(s_sorted), set(d_sorted)
            print(f"FAIL {name}: spark {len(srows)} rows, duck {len(drows)} rows; cols {scols}")
            print("   only spark:", sorted(sset - dset, key=key)[:4])
            print("   only duck: ", sorted(dset - sset, key=key)[:4])
    print(f"{bad} failing of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
