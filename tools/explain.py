"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
Check for PushedFilters / ReadSchema on scans, WholeStageCodegen spans,
Exchange placement and BroadcastHashJoin vs SortMergeJoin.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from astroframe.plans.registry import load_all
    from astroframe.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    for name in names:
        print(f"===== {name}")
        reg[name].spark(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
