"""Times the headline queries: ``BENCH_SF_DIR`` (tables) and ``BENCH_CPUS`` (threads).

Every query starts from the given tables and runs all layers; nothing is kept between
queries. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarlake.session import local_session  # noqa: E402
from checks.catalog import CHECKS  # noqa: E402

HEADLINE = [
    "clean_fait_ventes",
    "gold_fait_ventes",
    "sales_monthly",
    "kpi_global",
    "store_perf",
    "customer_perf",
    "stock_mgmt",
    "returns_analysis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        frame = CHECKS[name].spark(spark, folder)
        frame.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
