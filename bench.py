"""Times the headline queries and prints one JSON line.

Each query runs twice over the whole tables and the second run counts. Results
go to a sink that discards them, so that every row is computed and none is
collected.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tillroll.catalogue import QUERIES
from tillroll.session import local_session

HEADLINES = [
    "regional_running_sales",
    "top_products_by_category",
    "mom_growth",
    "discount_margin",
    "customer_deciles",
    "loss_making_subcategories",
    "monthly_sales_summary",
    "customer_concentration",
    "clean_audit",
    "fact_order_lines",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINES:
        seconds(name)
        timings[name] = round(seconds(name), 3)
    report = {
        "metric": "headline queries, total time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
