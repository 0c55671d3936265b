"""One warehouse run: CSV landing -> bronze -> silver -> gold, built lazily.

Every layer is written once to the run's folder under the shared checkpoint
root and read back from there, so the surrogate keys in the dimensions and
the fact agree, every later query starts from files (no recomputation of
earlier layers, no lineage across layers), and a lost executor only costs
its own tasks.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import skew
from strata.operators.ranking import scratch_of, scratch_root
from strata.plans import analytics, gold, quality, silver
from strata.schemas import SILVER_COLUMNS, TABLES
from strata.session import DEFAULT_AS_OF, enough_partitions
from strata.sources import bronze as bronze_src
from strata.sources.csv import CORRUPT
from strata.sources.fixtures import driver_table, malformed, source_table
from strata.sources.publication import Publication
from strata.sources.store import LayerStore, delete_folder, input_state, run_concurrently

# Null marker of the landing extracts written here ('' stays an empty string).
LANDING_NULL = "\\N"
PART_ROWS = 1 << 20  # sales rows in one partition of a shuffle, about


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None, as_of: str = DEFAULT_AS_OF,
                 store: LayerStore | None = None, strict: bool = False):
        """``store`` of an earlier run (``LayerStore(spark, run_id=...)``)
        reopens it: what it has written is not loaded again.  It must have
        been made from the same input."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.strict = strict
        self.store = store or LayerStore(spark)
        self.landing_dir = f"{self.store.root}/landing"
        self.null_values: tuple[str, ...] = (LANDING_NULL,)
        self._audit: dict[str, DataFrame] = {}
        self._heavy_keys: dict[str, DataFrame | None] | None = None
        self._locks: dict[str, threading.Lock] = {}
        self._locks_guard = threading.Lock()
        if sf_dir is not None:
            self._same_input(input_state(spark, sf_dir), as_of, strict)
            enough_partitions(spark, driver_table(spark, sf_dir, "lineitem").count(), PART_ROWS)

    def _same_input(self, *now) -> None:
        before = self.store.noted("input")
        if before is None:
            self.store.note(input=list(now))
        elif before != list(now):
            raise ValueError(f"run {self.store.run_id} was made from another input or date")

    def _same_extracts(self) -> None:
        """Extracts that a reopened run has loaded must be as they were; one
        that failed may be mended."""
        for e in self.store.events():
            if e["layer"] == "bronze" and e["status"] == "loaded" and "input" in e:
                if e["input"] != bronze_src.extract_state(self.spark, self.landing_dir, e["table"]):
                    raise ValueError(f"run {self.store.run_id} has loaded another {e['table']}")

    def _lock(self, name: str) -> threading.Lock:
        """One lock per layer or table: concurrent callers build each once.

        Keyed per table, so the fan-out threads of one build (which only
        touch other, already-loaded or independent tables) never wait on
        the lock their caller holds.
        """
        with self._locks_guard:
            return self._locks.setdefault(name, threading.Lock())

    @classmethod
    def from_csv(cls, spark: SparkSession, landing_dir: str, as_of: str = DEFAULT_AS_OF,
                 null_values: tuple[str, ...] = ("",), strict: bool = False,
                 store: LayerStore | None = None) -> "Warehouse":
        """A run over existing extracts (``source_crm/…``, ``source_erp/…``).

        A field equal to one of ``null_values`` is NULL (by default the empty
        field); in a text column the text ``n/a`` stays text.
        """
        w = cls(spark, None, as_of, store=store, strict=strict)
        w.landing_dir = landing_dir.rstrip("/")
        w.null_values = tuple(null_values)
        w._same_input(w.landing_dir, as_of, strict)
        w._same_extracts()
        w._audit["landed"] = None
        return w

    # ------------------------------------------------------------ sources
    def land(self, only: str | None = None) -> None:
        """Write the six source extracts as CSV files (the warehouse's input),
        or ``only`` one of them."""
        if "landed" in self._audit:
            return
        if only is None:
            run_concurrently({t: (lambda t=t: self.land(t)) for t in TABLES})
            self._audit["landed"] = None
            return
        with self._lock(f"landed/{only}"):
            if f"landed/{only}" not in self._audit:
                bronze_src.land_sources(self.spark, {only: source_table(self.spark, self.sf_dir, only)},
                                        self.landing_dir, LANDING_NULL, malformed(self.spark, self.sf_dir),
                                        compression="gzip")
                self._audit[f"landed/{only}"] = None

    def _loaded(self, layer: str, table: str, load) -> None:
        """One table of a layer, if it is not there yet: a query pays for the
        tables that it is made from, not for all six."""
        if layer in self._audit or f"{layer}/{table}" in self._audit:
            return
        with self._lock(f"{layer}/{table} load"):
            if f"{layer}/{table}" not in self._audit:
                load(table)
                self._audit[f"{layer}/{table}"] = None

    def _audited(self, layer: str, load) -> DataFrame:
        """The audit of a layer's load, which runs once (also if reopened)."""
        if layer not in self._audit:
            with self._lock(layer):
                if layer not in self._audit:
                    self._audit[layer] = load()
        return self._audit[layer]

    def load_audit(self, layer: str) -> DataFrame:
        """The latest outcome of each table, also after a load that failed."""
        return bronze_src.audit(self.store, layer)

    def _bronze(self, only: str | None = None) -> DataFrame:
        self.land(only)
        return bronze_src.load_bronze(self.store, self.landing_dir, self.null_values,
                                      lambda t: quality.row_checks("bronze", t, self.as_of), only)

    def load_bronze(self) -> DataFrame:
        return self._audited("bronze", self._bronze)

    def bronze(self, table: str) -> DataFrame:
        self._loaded("bronze", table, self._bronze)
        return bronze_src.bronze_table(self.store, table)

    def quarantine(self, table: str) -> DataFrame:
        self._loaded("bronze", table, self._bronze)
        return bronze_src.quarantine_table(self.store, table)

    # ------------------------------------------------------------ silver
    def _silver(self, only: str | None = None) -> DataFrame:
        if only is None:
            self.load_bronze()  # prerequisites in this thread, before fanning out
        else:
            self.bronze(only)

        def one(table: str) -> tuple[int, int]:
            with scratch_of(self.spark):
                self.store.write(
                    silver.build(table, self.bronze(table), self.as_of, self.strict), "silver", table,
                    observe={"rows": F.count(F.lit(1)),
                             **{k: F.count_if(c) for k, c in
                                quality.row_checks("silver", table, self.as_of).items()}})
            return self.store.metrics("silver", table)["rows"], 0

        return bronze_src.load_layer(self.store, "silver", one, only=only)

    def load_silver(self) -> DataFrame:
        return self._audited("silver", self._silver)

    def counted(self, layer: str, table: str) -> dict:
        """What was counted while a table was written: rows and row checks."""
        if layer == "bronze":
            self.bronze(table)
            return self.store.metrics("bronze_staged", table)
        if layer == "silver":
            self.silver(table)
        else:
            self.gold(table)
        return self.store.metrics(layer, table)

    def silver(self, table: str, with_load_ts: bool = False) -> DataFrame:
        self._loaded("silver", table, self._silver)
        df = self.store.read("silver", table)
        return df if with_load_ts else df.select(*SILVER_COLUMNS[table])

    # ------------------------------------------------------------ gold
    def _write_once(self, layer: str, name: str, build, **how) -> DataFrame:
        if not self.store.has(layer, name):
            with self._lock(f"{layer}/{name}"):
                if not self.store.has(layer, name):
                    with scratch_of(self.spark):  # nothing of it is left afterwards
                        self.store.write(build(), layer, name, **how)
        return self.store.read(layer, name)

    def _heavy(self) -> dict[str, DataFrame | None]:
        """Customers and products that hold too many sales for one partition."""
        with self._lock("heavy"):
            if self._heavy_keys is None:
                self._heavy_keys = skew.heavy_keys(self.silver("crm_sales_details"),
                                                   ["sls_cust_id", "sls_prd_key"])
            return self._heavy_keys

    def gold(self, name: str) -> DataFrame:
        if name == "dim_customers":
            return self._write_once("gold", name, lambda: gold.dim_customers(
                self.silver("crm_cust_info"), self.silver("erp_cust_az12"),
                self.silver("erp_loc_a101")))
        if name == "dim_products":
            return self._write_once("gold", name, lambda: gold.dim_products(
                self.silver("crm_prd_info"), self.silver("erp_px_cat_g1v2")))
        if name == "fact_sales":
            return self.sales().select(*self.store.columns("gold", name))
        raise KeyError(name)

    def sales(self) -> DataFrame:
        """The fact, bucketed by customer and salt, with both salts."""
        if not self.store.has("gold", "fact_sales"):
            run_concurrently({"heavy": self._heavy, **{d: (lambda d=d: self.gold(d))
                                                       for d in ("dim_customers", "dim_products")}})
            run_concurrently({"fact": self._fact, "customers": self.customers_keyed,
                              "products": self.products_keyed})
        return self._fact()

    def _fact(self) -> DataFrame:
        return self._write_once(
            "gold", "fact_sales", lambda: gold.fact_sales(
                self.silver("crm_sales_details"), self.gold("dim_products"), self.gold("dim_customers"),
                self._heavy()),
            observe={"rows": F.count(F.lit(1)), **{k: F.count_if(c) for k, c in quality.row_checks(
                "gold", "fact_sales", self.as_of).items()}},
            buckets=("customer_key", "c_salt"), hidden=("c_salt", "p_salt"))

    def sales_by_product(self) -> DataFrame:
        return self._write_once("work", "sales_by_product", lambda: gold.sales_by_product(self.sales()),
                                buckets=("product_key", "p_salt"))

    def customers_keyed(self) -> DataFrame:
        return self._write_once("work", "customers_keyed", lambda: gold.customers_keyed(
            self.gold("dim_customers"), self._heavy()["sls_cust_id"]), buckets=("customer_key", "c_salt"))

    def products_keyed(self) -> DataFrame:
        return self._write_once("work", "products_keyed", lambda: gold.products_keyed(
            self.gold("dim_products"), self._heavy()["sls_prd_key"]), buckets=("product_key", "p_salt"))

    # ------------------------------------------------------------ analytics
    def rfm_raw(self) -> DataFrame:
        return self._write_once("work", "rfm_raw", lambda: analytics.rfm_raw(
            self.sales(), self.customers_keyed(), self.as_of))

    def rfm_segmentation(self, best_high: bool = False) -> DataFrame:
        name = "rfm_scores_best_high" if best_high else "rfm_scores"
        scores = self._write_once("work", name,
                                  lambda: analytics.rfm_scores(self.rfm_raw(), best_high))
        return analytics.rfm_segments(scores)

    def customer_bitmaps(self) -> DataFrame:
        return self._write_once("work", "customer_bitmaps", lambda: analytics.customer_bitmaps(self.sales()))

    def monthly_revenue(self) -> DataFrame:
        return analytics.monthly_revenue(self.sales(), self.customer_bitmaps())

    def revenue_trends(self, exact: bool = False) -> DataFrame:
        return analytics.revenue_trends(self.monthly_revenue(), exact)

    def rfm_scores(self) -> DataFrame:
        self.rfm_segmentation()
        return self.store.read("work", "rfm_scores")

    def sales_marginals(self) -> DataFrame:
        return self._write_once("work", "sales_marginals", lambda: analytics.sales_marginals(
            self.sales(), self.gold("dim_products"), self.customers_keyed()))

    def kpi_summary(self, exact: bool = False) -> DataFrame:
        run_concurrently({"marginals": self.sales_marginals, "bitmaps": self.customer_bitmaps})
        return analytics.kpi_summary(self.sales(), self.gold("dim_products"), self.customers_keyed(), exact,
                                     self.sales_marginals(), self.customer_bitmaps())

    def product_sales(self, exact: bool = False) -> DataFrame:
        name = "product_sales_exact" if exact else "product_sales"
        return self._write_once("work", name, lambda: analytics.product_sales(
            self.sales_by_product(), self.products_keyed(), exact))

    def product_ranked(self, exact: bool = False) -> DataFrame:
        name = "product_ranked_exact" if exact else "product_ranked"
        return self._write_once("work", name, lambda: analytics.product_ranked(
            self.product_sales(exact), exact))

    def product_ties(self) -> DataFrame:
        """Best and worst products by revenue in whole 100,000s: ranks tie."""
        coarse = lambda ps: ps.withColumn(
            "total_revenue", F.call_function("div", F.col("total_revenue"), F.lit(100000)))
        return analytics.top_bottom(self._write_once(
            "work", "product_ties", lambda: analytics.product_ranked(coarse(self.product_sales()))))

    def product_performance(self, n: int = 10, exact: bool = False) -> DataFrame:
        return analytics.top_bottom(self.product_ranked(exact), n)

    # ------------------------------------------------------------ housekeeping
    def drop_scratch(self) -> None:
        """Delete the ranking scratch folders (every consumer reads layer tables)."""
        delete_folder(self.spark, scratch_root(self.spark))

    # ------------------------------------------------------------ publication
    def _layers(self) -> list[tuple[str, str, str, str | None]]:
        """(layer, table, folder's layer, condition) of all that is published."""
        self.load_silver()
        self.sales()
        return [*[("bronze", t, "bronze_staged", f"{CORRUPT} IS NULL") for t in TABLES],
                *[("silver", t, "silver", None) for t in TABLES],
                *[("gold", t, "gold", None) for t in ("dim_customers", "dim_products", "fact_sales")]]

    def publish(self, expected: int | None = None) -> int:
        """Make this run's tables the newest published version and return it.

        ``expected``: the version that the caller built on; it is an error if
        another one was published since (default: whatever is newest now).
        """
        tables = {f"{layer}.{t}": {
            "path": self.store.path(at, t), "schema": json.loads(self.store.schema(at, t).json()),
            "columns": [c for c in self.store.columns(at, t) if c != CORRUPT], "where": where}
            for layer, t, at, where in self._layers()}
        self.store.publish()
        target = Publication(self.spark, self.store.folder)
        newest = (target.versions() or [0])[-1]
        return target.publish({"run_id": self.store.run_id, "as_of": self.as_of, "tables": tables},
                              newest if expected is None else expected)

    # ------------------------------------------------------------ catalog
    def publish_catalog(self, durable: bool = False) -> list[str]:
        """Register the run's tables as ``bronze.*``, ``silver.*``, ``gold.*``.

        Views over the run's folders, replaced in one step, in databases whose
        location lies outside the runs.  With ``durable`` the session's
        catalog must outlive it; otherwise an in-memory catalog serves this
        session.
        """
        kind = self.spark.conf.get("spark.sql.catalogImplementation")
        if durable and kind == "in-memory":
            raise RuntimeError("the catalog is in-memory: nobody could query the tables after this "
                               "session; start it with a persistent catalog (for example "
                               "spark.sql.catalogImplementation=hive)")
        names = []
        for layer, t, at, where in self._layers():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} "
                           f"LOCATION '{self.store.base}/catalog/{layer}'")
            cols = ", ".join(c for c in self.store.columns(at, t) if c != CORRUPT)
            self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{t} AS SELECT {cols} "
                           f"FROM parquet.`{self.store.path(at, t)}` {'WHERE ' + where if where else ''}")
            names.append(f"{layer}.{t}")
        self.store.publish()
        return names


_RUNS: dict[tuple, Warehouse] = {}
_RUNS_LOCK = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> Warehouse:
    """The run for (session, input files, as-of date), built on first use: an
    input folder whose files changed gets a new run."""
    key = (spark.sparkContext.applicationId, input_state(spark, sf_dir), as_of)
    with _RUNS_LOCK:
        if key not in _RUNS:
            _RUNS[key] = Warehouse(spark, sf_dir, as_of)
        return _RUNS[key]
