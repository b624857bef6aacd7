"""Benchmark: headline queries on the given tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built (fixtures included: every query derives its inputs
from the given tables) and fully materialized with Spark's ``noop`` sink, so
the time is the whole job, not just the first rows.  One JSON line out.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from priceflow.plans import catalog  # noqa: E402
from priceflow.session import get_spark  # noqa: E402

HEADLINE = [
    "product_price",          # pages -> cards -> price rows (flagship)
    "append_country_table",   # the frame the sink appends
    "category_summary",       # C11
    "row_policy",             # R1
    "dedup_rows",             # D2
    "stop_on_empty_pages",    # C10
    "running_total",          # C12
    "page_advance_check",     # C14
    "classify_failures",      # C15
    "next_page",              # C13
    "menu_flatten",           # C6 + C7
    "number_requests",        # C1-C3
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="priceflow-bench", shuffle_partitions=max(2 * cpus, 8))
    run(spark, "product_price", "/root/testdata/sf0.01")    # JVM / JIT warm-up, not counted
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
