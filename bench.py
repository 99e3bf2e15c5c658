"""Time the headline queries and print one JSON line.

Each query is run to completion through a no-op sink, so every output column
is computed and nothing is collected. The freight tables are derived from the
test data and written once before, outside the timed part; a first small query
warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from haulmark.catalog import load_all  # noqa: E402
from haulmark.session import local_session  # noqa: E402
from haulmark.sources.testbed import TestBed  # noqa: E402

HEADLINE = [
    "allocate_invoices",
    "not_fully_billed",
    "backhaul_expense",
    "weekly_vendor_metrics",
    "weekly_margin_loss",
    "supplier_billing_report",
    "supplier_performance",
    "supplier_scorecard",
    "supplier_expense_by_mode",
    "budget_variance",
    "reprice_blended_rates",
    "pricing_out",
    "vendor_warehouse_list",
    "validate_forms",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="haulmark-bench-")
    spark = local_session(cpus, "haulmark-bench", int(cpus) if cpus.isdigit() else 8, f"{scratch}/shared")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    TestBed(spark, sf_dir).store(f"{scratch}/bed")

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("fiscal_window")
    times = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "settings": {"master": f"local[{cpus}]", "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
