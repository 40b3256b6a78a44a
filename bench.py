"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians, sec), "unit", "queries", "sf"}.
Each query is materialised to a no-op sink (the full plan runs, nothing is collected to the
driver); one warm-up run, then the median of $BENCH_REPEAT runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costlake.plans.catalog import QUERIES  # noqa: E402
from costlake.session import local_session  # noqa: E402

HEADLINE = [
    "clean_lineitems", "enriched_lineitems", "usage_daily", "bill_monthly", "discount_iceberg", "cpu_ratecard",
    "buying_efficiency", "wow_cost_movers", "storage_growth", "invoice_summary", "unit_cost", "base_load",
    "reconcile",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    timings = {}
    for name in names:
        fn = QUERIES[name]
        run(fn(spark, sf_dir))                      # warm-up
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            run(fn(spark, sf_dir))
            runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
