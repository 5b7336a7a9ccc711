"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query to completion (``noop`` sink: every row is
computed, nothing is collected to the driver) and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barsmith import get_session  # noqa: E402
from barsmith.plans.registry import all_queries  # noqa: E402

HEADLINE = ["feature_matrix", "drift_check", "walk_forward_folds", "backtest_prices"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = all_queries()
    # warm-up (not timed): the same code paths on the smallest data set, so
    # JIT compilation and class loading do not land in the first timing
    warm = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm):
        for name in HEADLINE:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
