"""Print the physical plan tree (and exchange count) of registered queries.

usage: python tools/plans.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plyspark.registry import QUERIES  # noqa: E402
from plyspark.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1]
    spark = get_session("local[8]", 8)
    for key in sys.argv[2:]:
        df = QUERIES[key](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree = [ln for ln in plan.splitlines()]
        print(f"== {key}: exchanges={sum('Exchange' in ln and 'Broadcast' not in ln and 'Reused' not in ln for ln in tree)} "
              f"broadcasts={sum('BroadcastExchange' in ln for ln in tree)}")
        for ln in tree:
            print("   ", ln[:160])


if __name__ == "__main__":
    main()
