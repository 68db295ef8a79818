"""Run every registered query in Spark and its oracle in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names (sorted) and the multiset of rows (values
normalised to text), like the driver's correctness gate.
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if v != v:
            return "∅"
        return repr(round(v, 6))
    if isinstance(v, Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def main():
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from strata.config import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ors:
            print(f"NOSQL {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(ors[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        if not ok:
            bad += 1
            print(f"FAIL {name}: cols_ok={ok_cols} spark={len(srows)} duck={len(drows)}")
            if not ok_cols:
                print("   spark cols", sorted(scols)); print("   duck  cols", sorted(dcols))
            else:
                sa, sb = set(a), set(b)
                print("   only spark:", sorted(sa - sb)[:3]); print("   only duck:", sorted(sb - sa)[:3])
        else:
            print(f"ok   {name}: {len(srows)} rows ({ts:.1f}s)")
    print("bad", bad)
    spark.stop()


if __name__ == "__main__":
    main()
