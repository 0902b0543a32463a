"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced end to end with the ``noop`` sink (fit actions included)
and timed.  Prints ONE JSON line, always: at the end, or with the queries done
so far when $BENCH_BUDGET seconds (default 1200) are over or the run is told to
stop.  Queries that train models run only with BENCH_ALL=1, after the others.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.catalog import HEADLINE, QUERIES  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402

EXTRA = ["en1_target_sigmoid", "en2_freq", "sc12_qcut10", "r4_numeric_profile", "r17_history",
         "ft3_rff", "ag15_kde", "tk5_best"]
FITTED = ["ft4_kmeans", "e1_features", "md5_boost", "md2_forest", "ev4_perm_importance", "tn1_search", "main_flow"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in HEADLINE + EXTRA + (FITTED if os.environ.get("BENCH_ALL") else []) if n in QUERIES]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    times: dict[str, float] = {}
    failed: dict[str, str] = {}

    def report(signum=None, frame=None) -> None:
        """Print what is known and end at once: Spark's shutdown may wait for running tasks."""
        why = "not reached" if signum is None else f"not finished ({signal.Signals(signum).name})"
        missing = {n: why for n in names if n not in times and n not in failed}
        print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                          "queries": times, "not_run": failed | missing, "sf": sf}), flush=True)
        os._exit(0)

    for s in (signal.SIGTERM, signal.SIGINT, signal.SIGALRM):
        signal.signal(s, report)
    signal.alarm(int(os.environ.get("BENCH_BUDGET", "1200")))
    spark = get_spark("ledgerlens-bench", master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)))
    # JVM / codegen warm-up on the smallest table, not timed
    QUERIES["r10_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # a failed query is reported, the others still count
            failed[name] = f"failed: {str(e)[:200]}"
    report()


if __name__ == "__main__":
    main()
