"""Headline queries: wall seconds, warm session, median of three runs, printed as one JSON line.

Each run builds the query and writes its whole result to Spark's no-op sink, so
no row is skipped by a limit or pruned column and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardmill.checks.registry import load_all  # noqa: E402
from wardmill.session import build_session, ensure_checkpoint_dir  # noqa: E402

HEADLINE = (
    "free_capacity_report", "region_rank_report", "persistent_overload_report", "trend_report", "feature_store",
    "utilization_silver", "rule_violations", "latest_line_per_key", "county_regions", "upserted", "hot_key_join",
    "enriched_forecast_table", "grouped_medians", "area_under_curve_overall", "ranked_with_ties", "strongest_contributions",
    "preprocessed_rows", "population_silver", "scored_snapshot",
)
RUNS = 3
#: Trains a model while it is built; one run without a warm-up.
ONCE = {"scored_snapshot"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus, os.environ.get("BENCH_MEMORY", "12g"),
                          {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="wardmill-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    checks = load_all()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for i in range(1, 2) if name in ONCE else range(RUNS + 1):
            start = time.perf_counter()
            checks[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:           # the first run warms code generation and the file cache
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": RUNS, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
