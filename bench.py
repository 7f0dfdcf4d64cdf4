"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each query is run once to warm up (this also writes the
derived event-log fixture once), then BENCH_RUNS times; the median wall time of
building the plan and executing it fully (``noop`` sink, nothing collected) is
reported per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perfkit.catalog import QUERIES  # noqa: E402
from perfkit.session import get_session  # noqa: E402

HEADLINE = ["stage_metrics", "findings_all", "recommendations", "topk_dense", "topk_text",
            "shadow_compare"]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    out, errors = {}, {}
    for n in names:
        try:
            run_once(spark, n, sf_dir)
            out[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(runs)), 3)
        except Exception as e:  # report the failure in the JSON line instead of losing the line
            out[n] = None
            errors[n] = f"{type(e).__name__}: {str(e)[:300]}"
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    rec = {"metric": "headline_total", "value": round(sum(v for v in out.values() if v is not None), 3),
           "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "runs": runs, "spark": spark.version}
    if errors:
        rec["errors"] = errors
    print(json.dumps(rec))
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
