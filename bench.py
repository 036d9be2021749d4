"""Times the headline queries; prints one JSON line.

Every query starts from the source tables (a new workspace each), so its time covers
the scan of the lines and all stages it needs. ``recursive_forecast`` alone reuses the
model fitted just before, as training and forecasting are separate steps.
"""

from __future__ import annotations

import json
import os
import time

from demandloom.plans.catalog import CATALOG
from demandloom.plans.workspace import Workspace
from demandloom.sources.storage import local_session

HEADLINE = [
    "sales_by_store", "revenue_by_store", "top_products_by_revenue", "monthly_demand_trend",
    "dense_panel", "training_features", "adaptive_forecasts", "metrics_by_series",
    "policy_summary", "allocate_proportional", "allocate_target_shortfall", "allocate_expected_cost",
    "fit_pooled_model",
]


def run(query: str, workspace: Workspace) -> float:
    began = time.perf_counter()
    CATALOG[query](workspace).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    run("load_summary", Workspace(spark, folder))  # start the JVM's hot paths
    seconds = {}
    for name in HEADLINE:
        workspace = Workspace(spark, folder)
        seconds[name] = run(name, workspace)
    workspace.state.count()
    seconds["recursive_forecast"] = run("recursive_forecast", workspace)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
