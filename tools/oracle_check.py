"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.oracle import compare, duck_connect  # noqa: E402
from inkstream.plans.registry import load_all  # noqa: E402
from inkstream.session import build_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    keys = a.keys or sorted(reg)
    spark = build_session()
    con = duck_connect(a.sf)
    bad = 0
    for k in keys:
        e = reg[k]
        t0 = time.time()
        try:
            sdf = e.build(spark, a.sf)
            if e.sql is None:
                n = sdf.count()
                print(f"ROWS {k}: {n} rows spark={time.time() - t0:.2f}s (no oracle)")
                continue
            ok, msg = compare(sdf, con, e.sql)
        except Exception as ex:  # noqa: BLE001
            ok, msg = False, f"error {type(ex).__name__}: {str(ex)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {k}: {msg} ({time.time() - t0:.2f}s)")
    print(f"{len(keys) - bad}/{len(keys)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
