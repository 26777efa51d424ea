"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPS``
(default 3) timed runs. A run executes the whole plan into Spark's ``noop``
sink (nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plyspark.registry import QUERIES  # noqa: E402
from plyspark.session import get_session  # noqa: E402

HEADLINE = [
    "parse_games",
    "parse_evals",
    "stage_moves",
    "move_features",
    "opening_patterns",
    "rating_trajectories",
    "rolling_form",
    "move_aggregates",
    "match_facts",
    "player_dim",
    "opening_dim",
    "data_checks",
]


def run_once(spark, key: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = get_session(
        f"local[{cpus}]",
        shuffle_partitions=max(cpus, 8),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    times: dict[str, float] = {}
    for key in keys:
        run_once(spark, key, sf)  # warm-up
        times[key] = round(statistics.median(run_once(spark, key, sf) for _ in range(reps)), 3)
    sf_name = os.path.basename(os.path.normpath(sf))
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_name.replace("sf", "") if sf_name.startswith("sf") else sf_name,
                "cpus": cpus,
                "reps": reps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
