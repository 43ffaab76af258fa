"""Print the formatted physical plan of registered queries (plan review aid).

    python tools/plans.py [--sf DIR] key [key ...]
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkstream.plans.registry import load_all  # noqa: E402
from inkstream.session import build_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="+")
    a = ap.parse_args()
    spark = build_session()
    reg = load_all()
    for k in a.keys:
        print(f"===== {k}")
        reg[k].build(spark, a.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
