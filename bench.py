"""Time the headline queries: one JSON line on the standard output.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the number of local
cores. ``load`` is the whole batch from the stored sources to the star schema; the
other times are queries on the loaded mart, the second run of each.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallyloom.plans import catalog
from tallyloom.plans.testmart import mart
from tallyloom.runtime import session

HEADLINE = [
    "B14_conform_sales", "C4_resolve_sk", "C6_insert_absent",
    "D1_company_totals", "D2_company_totals_customers", "D3_top_customers", "D5_city_sales_orders",
    "D6_monthly_change", "D8_company_comparison", "D9_decision_indicators", "D10_products",
    "D15_governorates", "E2_rfm_ntile", "E5_segmented_customers", "E6_segment_summary",
    "F4_holt_fit", "F10_forecast_long", "G1_global_row_number", "I8_all_checks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    timed("sources", lambda: mart(spark, folder))
    timed("load", lambda: mart(spark, folder).warehouse)
    registered = catalog.queries()
    for name in HEADLINE:
        for _ in range(2):
            timed(name, lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save())
    setup = times.pop("sources")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder), "cpus": int(cpus), "project_sources_sec": setup,
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
