"""Wall time of the headline queries: one warm-up run each, then the median of three.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local cores (default 8).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from tintero.session import local_session
from tintero_checks.queries import QUERIES

HEADLINE = (
    "top_terms_monthly",
    "base_counts",
    "regional_lift",
    "source_divergence",
    "daily_peaks",
    "clean_articles",
    "region_vote_default_aliases",
    "fact_assembly",
    "validation_report",
    "warehouse_job",
    "analytics_job",
)
RUNS = 3


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    times = {}
    for name in HEADLINE:
        runs = [seconds(spark, QUERIES[name], sf_dir) for _ in range(RUNS + 1)]
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
