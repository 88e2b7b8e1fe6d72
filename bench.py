"""Times the headline queries from raw tables to result and prints one JSON line.

Each query runs once to warm up and three times for the median. Nothing is cached between runs: every
run reads the source tables again. Results go to Spark's no-op sink, so all rows and columns are
computed and none is sent to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from costmart import build_session
from costmart.plans.catalog import QUERIES

HEADLINE = (
    "m01_int_hourly_compute_costs",
    "m02_fct_daily_costs",
    "m03_fct_daily_storage_costs",
    "m04_fct_total_cost_summary",
    "m05_fct_cost_forecast",
    "m06_int_top_spenders",
    "m07_fct_top_spenders",
    "m08_fct_cost_by_department",
    "m09_fct_budget_vs_actual",
    "m10_dim_warehouse",
    "a01_query_activity",
    "i02_upsert_table",
    "i04_legacy_tables",
    "d10_insights",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "costmart-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
