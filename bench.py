"""Benchmark: the whole warehouse run at $BENCH_SF_DIR on local[$BENCH_CPUS].

Times each stage of a fresh run (CSV landing, bronze load, silver load, gold
build) and the headline queries on top of it; each query is executed fully
through the ``noop`` sink (no driver collect).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import quality  # noqa: E402
from strata.plans.warehouse import Warehouse  # noqa: E402
from strata.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    w = Warehouse(spark, sf_dir)
    stages = [
        ("land_csv", w.land),
        ("load_bronze", w.load_bronze),
        ("load_silver", w.load_silver),
        # both dimensions (concurrently), then the fact that looks them up
        ("build_gold", lambda: w.gold("fact_sales")),
        ("revenue_trends", lambda: run(w.revenue_trends())),
        ("rfm_segmentation", lambda: run(w.rfm_segmentation())),
        ("kpi_summary", lambda: run(w.kpi_summary())),
        ("product_performance", lambda: run(w.product_performance())),
        ("check_orphans", lambda: run(quality.check_orphans(w))),
        ("data_quality_report", lambda: run(quality.data_quality_report(w))),
    ]
    times = {}
    for name, fn in stages:
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
    w.drop_scratch()  # the run is throwaway: leave no data behind
    w.store.drop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "warehouse_run_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
