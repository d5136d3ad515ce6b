"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python scripts/compare.py [sf_dir] [key-substring ...]
Prints one line per key: OK / MISMATCH (rows, columns, values) / ERROR.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from kestrel.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from kestrel.session import get_session  # noqa: E402
from kestrel.sources.tables import TABLES  # noqa: E402


def norm(v, digits=9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if abs(v) < 1e-9:
            return 0.0
        return float(f"{v:.{digits}g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "asDict"):
        return norm(v.asDict(), digits)
    return v


def rows_of(cols, records, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], digits) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if not os.path.isdir(a)]
    load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for key in sorted(QUERIES):
        if pats and not any(p in key for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = QUERIES[key](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            ts = time.time() - t0
            if key not in ORACLE:
                print(f"ROWS-ONLY {key}: {len(srows)} rows ({ts:.1f}s)")
                continue
            res = con.execute(ORACLE[key])
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
            msgs = []
            if len(srows) != len(drows):
                msgs.append(f"rows {len(srows)} vs {len(drows)}")
            if sorted(scols) != sorted(dcols):
                msgs.append(f"cols {sorted(scols)} vs {sorted(dcols)}")
            elif rows_of(scols, srows, 9) != rows_of(dcols, drows, 9):
                a, b = rows_of(scols, srows, 9), rows_of(dcols, drows, 9)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                msgs.append(f"values differ e.g. {diff}")
            if msgs:
                bad += 1
                print(f"MISMATCH {key}: {'; '.join(msgs)} ({ts:.1f}s)")
            else:
                ok += 1
                print(f"OK {key}: {len(srows)} rows ({ts:.1f}s)")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {key}: {type(e).__name__}: {str(e)[:600]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
        sys.stdout.flush()
    print(f"== {ok} ok, {bad} bad")


if __name__ == "__main__":
    main()
