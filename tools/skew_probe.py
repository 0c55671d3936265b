"""Skew probe: the fact build and the RFM/product aggregates under a hot key.

Derives a skewed copy of the silver sales from the driver tables (a third
of the rows moved to one customer, another third with a NULL product key),
forces shuffle joins as at scale (no broadcast) and scales AQE's skew
thresholds down to the data, then prints the per-stage task balance.

Usage: python tools/skew_probe.py [SF_DIR] [--no-skew-join] [--replicate=R]
(writes its event log to a fresh /tmp folder; --no-skew-join turns AQE's
skew split off to show the unmitigated hot partition)
"""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    skew_join = "--no-skew-join" not in sys.argv
    rep = int(next((a.split("=")[1] for a in sys.argv if a.startswith("--replicate=")), "1"))
    log_dir = tempfile.mkdtemp(prefix="strata-skew-")
    os.environ["STRATA_EVENT_LOG_DIR"] = log_dir
    from pyspark.sql import functions as F

    from strata.plans import analytics, gold
    from strata.plans.warehouse import Warehouse
    from strata.session import build_session

    spark = build_session(shuffle_partitions=16)
    w = Warehouse(spark, sf_dir)
    w.load_silver()
    dp, dc = w.gold("dim_products"), w.gold("dim_customers")
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
                 "spark.sql.adaptive.skewJoin.enabled": str(skew_join).lower()}.items():
        spark.conf.set(k, v)
    sd = w.silver("crm_sales_details")
    hot = sd.agg(F.min("sls_cust_id")).first()[0]
    bucket = F.pmod(F.xxhash64("sls_ord_num", "sls_prd_key"), F.lit(3))
    skewed = sd.select(
        "sls_ord_num",
        F.when(bucket == 1, F.lit(None).cast("string")).otherwise(F.col("sls_prd_key"))
         .alias("sls_prd_key"),
        F.when(bucket == 0, F.lit(hot)).otherwise(F.col("sls_cust_id")).alias("sls_cust_id"),
        *[c for c in sd.columns if c not in ("sls_ord_num", "sls_prd_key", "sls_cust_id")])
    if rep > 1:  # R copies of every row, each a distinct order (sequence + explode)
        skewed = (skewed.select("*", F.explode(F.sequence(F.lit(1), F.lit(rep))).alias("_r"))
                  .withColumn("sls_ord_num", F.concat_ws("-", "sls_ord_num", F.col("_r").cast("string")))
                  .drop("_r"))
        skewed = w.store.write(skewed, "skew", "sales_input")
    spark.sparkContext.setJobDescription("skew: fact build")
    fact = w.store.write(gold.fact_sales(skewed, dp, dc), "skew", "fact_sales")
    spark.sparkContext.setJobDescription("skew: rfm_raw")
    w.store.write(analytics.rfm_raw(fact, dc, w.as_of), "skew", "rfm_raw")
    spark.sparkContext.setJobDescription("skew: product_sales")
    w.store.write(analytics.product_sales(fact, dp), "skew", "product_sales")
    spark.stop()
    log = os.path.join(log_dir, sorted(os.listdir(log_dir))[0])
    here = os.path.dirname(os.path.abspath(__file__))
    subprocess.run([sys.executable, os.path.join(here, "stage_report.py"), log, "12"], check=True)


if __name__ == "__main__":
    main()
