"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain.py [sf_dir] query [query ...]

AQE is switched off here so the whole static plan is visible at once (with
AQE on, Spark re-plans stage by stage at run time from measured sizes).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from areatab.plans.registry import QUERIES  # noqa: E402
from areatab.session import get_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = get_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for name in args or ["freq_all"]:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
