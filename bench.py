"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs
per query (the best one counts, after one run to warm up).
"""

from __future__ import annotations

import json
import os
import sys
import time

from ospara.plans import load_all
from ospara.session import local_session

HEADLINE = (
    "m24_severity_scoring", "t01_nearest_cosine", "t02_nearest_euclidean", "a01_severity_summary", "a07_describe",
    "d04_detections", "d01_document_chunks", "f11_overlapping_chunks", "f15_span_masking", "j03_keyword_rules",
    "w01_sequence_windows", "w02_seasonal_forecast", "w05_running_kpis", "m04_scale_robust", "m05_impute_and_scale",
    "m11_silhouette", "m12_davies_bouldin", "m13_choose_k", "m09_dbscan_clusters", "m17_anomaly_forest",
    "r03_permission_decision", "s15_upsert", "k04_device_state", "k07_tumbling_windows", "q01_equi_joins",
)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus)
    plans = load_all()
    chosen = [n for n in plans if any(n.startswith(p) for p in names)] if names else list(HEADLINE)
    seconds = {}
    for name in chosen:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            plans[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt or runs == 0:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
