"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma separated, or "all"; default HEADLINES).
Each query is run to the end into a no-op sink; the first run warms up, the median of the
others counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from limitlens.queries.registry import QUERIES  # noqa: E402
from limitlens.session import local_session  # noqa: E402


HEADLINES = [
    "weekly_report", "spec_stats", "outlier_bounds", "latest_limits", "compliance_verdict",
    "catalog_union", "catalog_dedup", "refresh_window", "day_manifest", "fetch_plan",
    "manifest_verify", "readings_filtered", "tool_window_scan", "work_week_lookup",
    "spec_chunks", "run_log_summary", "compact_chunks",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus, "bench")
    times = {}
    for name in names:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
