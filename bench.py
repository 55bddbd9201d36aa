"""Bench: headline queries on $BENCH_SF_DIR (default sf0.1), local[$BENCH_CPUS].

Prints one JSON line.  Each query is run once cold (the first run also warms
the JVM) and then timed as the median of $BENCH_RUNS runs.  Caches are cleared
before every run, so every run fits its model anew, and results go to a
``noop`` sink.  ``value`` is the sum of the medians; ``jobs`` counts the Spark
jobs of one run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nextbest.plans import queries as registry  # noqa: E402
from nextbest.session import local_session  # noqa: E402

HEADLINE = ["recommend_topk", "nb_likelihood", "nb_score", "recommend_exhausted",
            "map_at_k", "recommend_and_evaluate", "clean_snapshot", "encode_categories",
            "group_median_fill", "sort_records"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus))))
    spark = local_session(cpus, parts, app="nextbest-bench")
    tracker = spark.sparkContext.statusTracker()
    qs = registry.queries()
    out, jobs = {}, {}
    for name in HEADLINE:
        times = []
        for n in range(runs + 1):
            spark.catalog.clearCache()
            group = f"{name}-{n}"
            spark.sparkContext.setJobGroup(group, group)
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
            jobs[name] = len(tracker.getJobIdsForGroup(group))
        out[name] = round(statistics.median(times[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "jobs": jobs, "sf": sf, "cpus": cpus,
                      "runs": runs}))


if __name__ == "__main__":
    main()
