"""Print the formatted physical plan of registered queries.

    python tools/explain_query.py [sf_dir] name [name ...]

Use it to check that filters reach the scan (PushedFilters / ReadSchema),
which joins are broadcast, and where exchanges sit.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from chronoledger.plans import registry
    from chronoledger.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    for name in names:
        print(f"==== {name}")
        registry.QUERIES[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
