"""Run the warehouse from the command line.

    python -m strata --landing DIR [--as-of YYYY-MM-DD] [--strict] [--out DIR]
    python -m strata --sf-dir /root/testdata/sf0.01      # derive the extracts first
    python -m strata --read gold.fact_sales --root DIR   # a table of the published version

Loads bronze and silver, builds gold, publishes ``bronze.*``, ``silver.*``,
``gold.*`` as the next version under the runs' folder and in the session's
catalog (``--publish``: one that outlives it), prints the run id, the load
audits, the data-quality summary and the KPI row, and with ``--out`` writes
every analytics result as parquet.  A load that fails prints the audit with
the failed tables; ``--run-id`` goes on with these alone.
"""

from __future__ import annotations

import argparse

from strata.plans import quality
from strata.plans.warehouse import Warehouse
from strata.session import DEFAULT_AS_OF, build_session
from strata.sources.bronze import LoadFailed
from strata.sources.publication import Publication
from strata.sources.store import LayerStore


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing", help="folder with source_crm/ and source_erp/ CSV extracts")
    src.add_argument("--sf-dir", help="driver tables to derive the extracts from")
    src.add_argument("--read", metavar="TABLE", help="show a table of the published version")
    ap.add_argument("--root", help="folder of the runs (default: the session's checkpoint folder)")
    ap.add_argument("--version", type=int, help="with --read: this version instead of the newest")
    ap.add_argument("--as-of", default=DEFAULT_AS_OF, help="'today' for date rules")
    ap.add_argument("--null-value", action="append", help="NULL marker in the extracts (repeatable)")
    ap.add_argument("--run-id", help="reopen this run instead of loading again")
    ap.add_argument("--publish", action="store_true",
                    help="the tables must stay in the catalog (an error if it is in-memory)")
    ap.add_argument("--strict", action="store_true", help="fail on impossible yyyymmdd dates")
    ap.add_argument("--out", help="write analytics results as parquet under this folder")
    ap.add_argument("--keep-runs", type=int, default=0,
                    help="after publishing, keep only the newest N run folders (0: keep all)")
    args = ap.parse_args(argv)

    spark = build_session()
    published = Publication(spark, args.root)
    if args.read:
        snapshot = published.open(args.version)
        if snapshot is None:
            raise SystemExit("nothing is published")
        print("version:", snapshot.version, "run:", snapshot.run_id)
        snapshot.table(args.read).show(truncate=False)
        return
    built_on = (published.versions() or [0])[-1]
    store = LayerStore(spark, root=args.root, run_id=args.run_id)
    if args.landing:
        w = Warehouse.from_csv(spark, args.landing, args.as_of, tuple(args.null_value or ("",)),
                               args.strict, store)
    else:
        w = Warehouse(spark, args.sf_dir, args.as_of, store, args.strict)
    print("run:", w.store.run_id)
    for layer, load in (("bronze", w.load_bronze), ("silver", w.load_silver)):
        try:
            load().show(truncate=False)
        except LoadFailed:
            w.load_audit(layer).show(truncate=False)
            raise
    print("published:", ", ".join(w.publish_catalog(durable=args.publish)))
    print("version:", w.publish(built_on))
    if args.keep_runs:
        print("retired:", len(w.store.retire_older_runs(args.keep_runs)), "older run(s)")
    quality.data_quality_report(w).show(50, truncate=False)
    w.kpi_summary().show(truncate=False)
    if args.out:
        results = {"rfm_segmentation": w.rfm_segmentation(),
                   "revenue_trends": w.revenue_trends(),
                   "kpi_summary": w.kpi_summary(),
                   "product_performance": w.product_performance()}
        for name, df in results.items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        print("written:", ", ".join(results))
    spark.stop()


if __name__ == "__main__":
    main()
