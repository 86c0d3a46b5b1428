"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3), BENCH_QUERIES (comma list).
Each query gets one warm-up run, then the median of the timed runs; results
are forced with the ``noop`` writer so nothing is collected to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.queries import queries  # noqa: E402
from salesmart.session import local_session  # noqa: E402

HEADLINE = (
    "sales_mart",            # the whole refresh extract: 28 relations, 9 lookups, DISTINCT
    "mart_refresh",          # job A end to end: two daily runs, atomic window replace, read back
    "distinct_rows",         # its DISTINCT block alone
    "orders_in_scope",       # order side: type, user, order-line flags, price list, delivery
    "returns_invoice_list",  # shared returns rollup (sum + ordered string list)
    "invoice_total",         # correlated invoice total, decorrelated
    "min_delivery_lookup",   # 3-table rollup per order number
    "semi_join_theta",       # existence test with an OR condition
    "window_refresh",        # publish: full history, then a window replace, read back
    "full_copy",             # full replace twice and read back
)


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="salesmart-bench")
    registry = queries()
    results = {}
    for name in names:
        fn = registry[name]
        run_once(spark, fn, sf_dir)  # warm-up
        results[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
