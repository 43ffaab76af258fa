"""Print the SURVEY §2 inventory ids covered by registered queries (markdown)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkstream.plans.registry import load_all  # noqa: E402

GROUPS = [("S", 15), ("K", 13), ("P", 17), ("T", 25), ("E", 6), ("A", 7), ("V", 9), ("G", 12), ("U", 2), ("R", 6)]


def main():
    reg = load_all()
    by_id = {}
    for k, e in sorted(reg.items()):
        for i in e.ids.split():
            by_id.setdefault(i, []).append(f"`{k}`" + ("" if e.sql else " (rows)"))
    print("| ID | registered queries |\n|---|---|")
    for p, n in GROUPS:
        for i in range(1, n + 1):
            key = f"{p}{i}"
            print(f"| {key} | {', '.join(by_id.get(key, [])) or '-'} |")


if __name__ == "__main__":
    main()
