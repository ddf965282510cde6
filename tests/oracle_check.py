"""Run registered queries in Spark and their SQL in DuckDB, compare
row count, column names/types and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def value_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from turnstile.session import local_session

    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows-only  n={len(srows)}  {dt:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = value_hash(srows, scols)
        hd, ld = value_hash(drows, dcols)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        print(f"{name:28s} {'OK ' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} {dt:.1f}s")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(dcols):
                print("   cols spark", sorted(scols), "\n   cols duck ", sorted(dcols))
            diff_s = sorted(set(ls) - set(ld))[:3]
            diff_d = sorted(set(ld) - set(ls))[:3]
            print("   only spark:", diff_s, "\n   only duck: ", diff_d)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
