"""Time the headline queries; prints one JSON line.

Each query runs twice over the whole tables, with its result fully computed and
thrown away; the better time counts.
"""

from __future__ import annotations

import json
import os
import time

from batchgauge.queries import QUERIES
from batchgauge.session import local_session

HEADLINE = [
    "score_expr",
    "score_map_in_pandas",
    "gate_report_all",
    "mon_report",
    "psi_all_features",
    "psi_rolling_30d",
    "m_evaluate",
    "m_auc_ovr",
    "m_by_run_date",
    "sink_key_dedup",
    "sink_replace_date",
    "backfill_range",
    "fe_quantiles",
    "label_synthetic",
    "split_stratified",
    "model_alias_resolve",
    "view_histogram",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores))
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "runs": RUNS, "cores": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
