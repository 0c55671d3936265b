"""The warehouse's quality checks: silver suite, gold suite, cross-layer report.

Each check returns the rows it flags (empty = pass), except the listings
(``domain_*``, ``report_domains``, ``report_countries``) and the counts
(``report_bronze_counts``, ``report_bronze_null_keys``, ``report_whitespace``)
which always return rows.  ``data_quality_report`` folds every pass/fail
check into one summary with one scan per table.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import (
    check_fk, check_trimmed, check_unique, domain, lookup, not_trimmed, profile,
)
from strata.schemas import SILVER_COLUMNS, TABLES

BDATE_MIN = "1924-01-01"


def _any(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _d(s: str) -> Column:
    return F.lit(s).cast("date")


# ---------------------------------------------------------------- predicates
def bad_due_dt() -> Column:
    c = F.col("sls_due_dt")
    return _any(c <= 0, F.length(c.cast("string")) != 8, c > 20500101, c < 19000101)


def bad_date_order() -> Column:
    return _any(F.col("sls_order_dt") > F.col("sls_ship_dt"),
                F.col("sls_order_dt") > F.col("sls_due_dt"))


def bad_amounts(tolerance: int | None = None) -> Column:
    s, q, p = [F.col(c).cast("long") for c in ("sls_sales", "sls_quantity", "sls_price")]
    mismatch = (s != q * p) if tolerance is None else (F.abs(s - q * p) > tolerance)
    return _any(mismatch, s.isNull(), q.isNull(), p.isNull(), s <= 0, q <= 0, p <= 0)


def bad_cost() -> Column:
    return (F.col("prd_cost") < 0) | F.col("prd_cost").isNull()


def bad_bdate(as_of: str) -> Column:
    return (F.col("bdate") < _d(BDATE_MIN)) | (F.col("bdate") > _d(as_of))


def bad_amount() -> Column:
    return (F.col("sales_amount") <= 0) | F.col("sales_amount").isNull()


# The row-level checks of each table, counted while it is written.  A layer
# that is loaded needs no scan to report them.
ROW_CHECKS: dict[tuple[str, str], Callable[[str], dict[str, Column]]] = {
    ("bronze", "crm_cust_info"): lambda as_of: {"null_cst_id": F.col("cst_id").isNull()},
    ("bronze", "crm_sales_details"): lambda as_of: {"null_sls_ord_num": F.col("sls_ord_num").isNull()},
    ("silver", "crm_cust_info"): lambda as_of: {"cst_key_whitespace": not_trimmed("cst_key")},
    ("silver", "crm_prd_info"): lambda as_of: {
        "bad_prd_cost": bad_cost(), "prd_nm_whitespace": not_trimmed("prd_nm")},
    ("silver", "crm_sales_details"): lambda as_of: {
        "sales_mismatch": bad_amounts(tolerance=1), "order_after_ship_or_due": bad_date_order()},
    ("silver", "erp_cust_az12"): lambda as_of: {"bdate_out_of_range": bad_bdate(as_of)},
    ("gold", "fact_sales"): lambda as_of: {"bad_sales_amount": bad_amount()},
}


def row_checks(layer: str, table: str, as_of: str) -> dict[str, Column]:
    return ROW_CHECKS.get((layer, table), lambda as_of: {})(as_of)


# ---------------------------------------------------------------- silver suite
def check_cust_id_unique(w) -> DataFrame:
    return check_unique(w.silver("crm_cust_info"), "cst_id", null_is_violation=True)


def check_cust_key_trim(w) -> DataFrame:
    return check_trimmed(w.silver("crm_cust_info"), ["cst_key"])


def check_prd_id_unique(w) -> DataFrame:
    return check_unique(w.silver("crm_prd_info"), "prd_id", null_is_violation=True)


def check_prd_nm_trim(w) -> DataFrame:
    return check_trimmed(w.silver("crm_prd_info"), ["prd_nm"])


def check_prd_cost(w) -> DataFrame:
    return w.silver("crm_prd_info").filter(bad_cost()).select("prd_cost")


def check_prd_date_order(w) -> DataFrame:
    return w.silver("crm_prd_info").filter(F.col("prd_end_dt") < F.col("prd_start_dt"))


def check_due_dt_valid(w) -> DataFrame:
    """Reads *bronze*: the raw integer due dates that would not parse."""
    return (w.bronze("crm_sales_details").filter(bad_due_dt())
            .select(F.nullif(F.col("sls_due_dt"), F.lit(0)).alias("sls_due_dt")))


def check_sales_date_order(w) -> DataFrame:
    return w.silver("crm_sales_details").filter(bad_date_order())


def check_sales_consistency(w) -> DataFrame:
    cols = ["sls_sales", "sls_quantity", "sls_price"]
    return (w.silver("crm_sales_details").filter(bad_amounts()).select(*cols).distinct()
            .orderBy(*[F.col(c).asc_nulls_first() for c in cols]))


def check_bdate_range(w) -> DataFrame:
    return w.silver("erp_cust_az12").filter(bad_bdate(w.as_of)).select("bdate").distinct()


def check_px_cat_trim(w) -> DataFrame:
    return check_trimmed(w.silver("erp_px_cat_g1v2"), ["cat", "subcat", "maintenance"],
                         SILVER_COLUMNS["erp_px_cat_g1v2"])


# ---------------------------------------------------------------- gold suite
def check_customer_key_unique(w) -> DataFrame:
    return check_unique(w.gold("dim_customers"), "customer_key", "duplicate_count")


def check_product_key_unique(w) -> DataFrame:
    return check_unique(w.gold("dim_products"), "product_key", "duplicate_count")


def check_customer_id_unique(w) -> DataFrame:
    """Business key: catches ERP fan-out, which surrogate keys can never show."""
    return check_unique(w.gold("dim_customers"), "customer_id", "duplicate_count")


def check_product_number_unique(w) -> DataFrame:
    """Business key: keys that differ only in category collapse after the cut."""
    return check_unique(w.gold("dim_products"), "product_number", "duplicate_count")


def orphans(w) -> DataFrame:
    return check_fk(w.gold("fact_sales"), [(w.gold("dim_customers"), "customer_key", "c_"),
                                           (w.gold("dim_products"), "product_key", "p_")])


def check_orphans(w) -> DataFrame:
    return orphans(w)


# ---------------------------------------------------------------- report
BRONZE_LABEL = "bronze.{}"
# Check labels of the cross-layer report.
NULL_KEY_LABELS = ("bronze.crm_cust_info — null cst_id", "bronze.crm_sales_details — null order num")
WHITESPACE_LABELS = ("crm_cust_info — cst_key has leading/trailing space",
                     "crm_prd_info — prd_nm has leading/trailing space")


def _listed(w, rows: list[tuple], schema: str) -> DataFrame:
    """Counts taken at write time as a frame: no table is read."""
    return w.spark.createDataFrame(rows, schema)


def report_bronze_counts(w) -> DataFrame:
    return _listed(w, [(BRONZE_LABEL.format(t), w.counted("bronze", t)["rows"]) for t in TABLES],
                   "table_name string, row_count long")


def report_bronze_null_keys(w) -> DataFrame:
    return _listed(w, [
        (NULL_KEY_LABELS[0], w.counted("bronze", "crm_cust_info")["null_cst_id"]),
        (NULL_KEY_LABELS[1], w.counted("bronze", "crm_sales_details")["null_sls_ord_num"])],
        "check_name string, violation_count long")


def report_dup_cust(w) -> DataFrame:
    return check_unique(w.silver("crm_cust_info"), "cst_id", "duplicate_count")


def report_bad_cost(w) -> DataFrame:
    return w.silver("crm_prd_info").filter(bad_cost()).select("prd_id", "prd_nm", "prd_cost")


def report_sales_mismatch(w) -> DataFrame:
    return (w.silver("crm_sales_details").filter(bad_amounts(tolerance=1))
            .select("sls_ord_num", "sls_quantity", "sls_price", "sls_sales",
                    (F.col("sls_quantity").cast("long") * F.col("sls_price").cast("long"))
                    .alias("expected_sales")))


def report_date_order(w) -> DataFrame:
    return (w.silver("crm_sales_details").filter(bad_date_order())
            .select("sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt"))


def report_bdate(w) -> DataFrame:
    return w.silver("erp_cust_az12").filter(bad_bdate(w.as_of)).select("cid", "bdate")


def report_whitespace(w) -> DataFrame:
    return _listed(w, [
        (WHITESPACE_LABELS[0], w.counted("silver", "crm_cust_info")["cst_key_whitespace"]),
        (WHITESPACE_LABELS[1], w.counted("silver", "crm_prd_info")["prd_nm_whitespace"])],
        "issue string, cnt long")


def report_domains(w) -> DataFrame:
    """The three code listings in one result, tagged by column name."""
    ci, ca = w.silver("crm_cust_info"), w.silver("erp_cust_az12")
    parts = [df.select(F.lit(c).alias("column_name"), F.col(c).alias("value")).distinct()
             for df, c in ((ci, "cst_gndr"), (ci, "cst_marital_status"), (ca, "gen"))]
    return reduce(DataFrame.unionAll, parts)


def report_orphans(w) -> DataFrame:
    o = orphans(w)
    return o.select(
        "order_number", "customer_key", "product_key",
        F.when(F.col("c_customer_key").isNull(), "Missing customer").otherwise("")
         .alias("customer_issue"),
        F.when(F.col("p_product_key").isNull(), "Missing product").otherwise("")
         .alias("product_issue"))


def report_bad_amount(w) -> DataFrame:
    return w.gold("fact_sales").filter(bad_amount()).select("order_number", "sales_amount")


def data_quality_report(w) -> DataFrame:
    """Every pass/fail check as (layer, check_name, violations, passed).

    Row-level checks were counted while the layers were written; only what
    needs other rows reads a table: key uniqueness (a grouped count of the key
    alone, partial counts map-side) and orphans (the fact's keys against both
    dimensions).
    """
    counted = [(layer, name, w.counted(layer, table)[name])
               for layer, table in ROW_CHECKS for name in row_checks(layer, table, w.as_of)]

    def repeated(layer: str, df: DataFrame, key: str, name: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.agg(F.count_if(F.col("_n") > 1).alias("violations")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("check_name"), "violations")

    lost = check_fk_flags(w).agg(F.count_if("_orphan").alias("violations")).select(
        F.lit("gold").alias("layer"), F.lit("orphan_fact_rows").alias("check_name"), "violations")
    out = reduce(DataFrame.unionAll, [
        _listed(w, counted, "layer string, check_name string, violations long"),
        repeated("silver", w.silver("crm_cust_info"), "cst_id", "duplicate_cst_id"),
        repeated("gold", w.gold("dim_customers"), "customer_key", "duplicate_customer_key"),
        repeated("gold", w.gold("dim_products"), "product_key", "duplicate_product_key"),
        lost])
    run_date = F.date_format(F.lit(w.as_of).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return out.withColumn("passed", F.col("violations") == 0).withColumn("run_date", run_date)


def check_fk_flags(w) -> DataFrame:
    """The fact's keys with their dimension lookups and an ``_orphan`` flag per row."""
    f = lookup(w.gold("fact_sales").select("customer_key", "product_key"),
               w.gold("dim_customers").select("customer_key"), "customer_key", "c_")
    f = lookup(f, w.gold("dim_products").select("product_key"), "product_key", "p_")
    return f.withColumn("_orphan", F.col("c_customer_key").isNull() | F.col("p_product_key").isNull())


# ---------------------------------------------------------------- loads
def profile_tables(w) -> DataFrame:
    """Pre-load profile of every bronze table."""
    return reduce(DataFrame.unionAll, [profile(w.bronze(t), t) for t in TABLES])


def bronze_load_audit(w) -> DataFrame:
    """Load audit without the wall-clock seconds (kept by ``load_bronze``)
    and the errors (a load that has any raises)."""
    return w.load_bronze().drop("seconds", "error")


def silver_load_audit(w) -> DataFrame:
    return w.load_silver().drop("seconds", "error")


def with_copies(df: DataFrame, key: str) -> DataFrame:
    """The keys of ``df``, those divisible by 7 twice: a frame on which a
    uniqueness check must fire (the warehouse's own keys are unique)."""
    k = df.select(key)
    return k.unionAll(k.filter(F.col(key) % 7 == 0))


CHECKS: dict[str, Callable] = {
    "check_cust_id_unique_violated": lambda w: check_unique(
        with_copies(w.silver("crm_cust_info"), "cst_id"), "cst_id", null_is_violation=True),
    "check_customer_key_unique_violated": lambda w: check_unique(
        with_copies(w.gold("dim_customers"), "customer_key"), "customer_key", "duplicate_count"),
    "check_product_key_unique_violated": lambda w: check_unique(
        with_copies(w.gold("dim_products"), "product_key"), "product_key", "duplicate_count"),
    "report_dup_cust_violated": lambda w: check_unique(
        with_copies(w.silver("crm_cust_info"), "cst_id"), "cst_id", "duplicate_count"),
    "report_dup_customer_key_violated": lambda w: check_unique(
        with_copies(w.gold("dim_customers"), "customer_key"), "customer_key", "dup_count"),
    "report_dup_product_key_violated": lambda w: check_unique(
        with_copies(w.gold("dim_products"), "product_key"), "product_key", "dup_count"),
    "check_cust_id_unique": check_cust_id_unique,
    "check_cust_key_trim": check_cust_key_trim,
    "domain_marital_status": lambda w: domain(w.silver("crm_cust_info"), "cst_marital_status"),
    "check_prd_id_unique": check_prd_id_unique,
    "check_prd_nm_trim": check_prd_nm_trim,
    "check_prd_cost": check_prd_cost,
    "domain_prd_line": lambda w: domain(w.silver("crm_prd_info"), "prd_line"),
    "check_prd_date_order": check_prd_date_order,
    "check_due_dt_valid": check_due_dt_valid,
    "check_sales_date_order": check_sales_date_order,
    "check_sales_consistency": check_sales_consistency,
    "check_bdate_range": check_bdate_range,
    "domain_gen": lambda w: domain(w.silver("erp_cust_az12"), "gen"),
    "domain_cntry": lambda w: domain(w.silver("erp_loc_a101"), "cntry", ordered=True),
    "check_px_cat_trim": check_px_cat_trim,
    "domain_maintenance": lambda w: domain(w.silver("erp_px_cat_g1v2"), "maintenance"),
    "check_customer_key_unique": check_customer_key_unique,
    "check_product_key_unique": check_product_key_unique,
    "check_customer_id_unique": check_customer_id_unique,
    "check_product_number_unique": check_product_number_unique,
    "check_orphans": check_orphans,
    "report_bronze_counts": report_bronze_counts,
    "report_bronze_null_keys": report_bronze_null_keys,
    "report_dup_cust": report_dup_cust,
    "report_bad_cost": report_bad_cost,
    "report_sales_mismatch": report_sales_mismatch,
    "report_date_order": report_date_order,
    "report_bdate": report_bdate,
    "report_whitespace": report_whitespace,
    "report_domains": report_domains,
    "report_countries": lambda w: domain(w.silver("erp_loc_a101"), "cntry", ordered=True),
    "report_dup_customer_key": lambda w: check_unique(w.gold("dim_customers"), "customer_key",
                                                      "dup_count"),
    "report_dup_product_key": lambda w: check_unique(w.gold("dim_products"), "product_key",
                                                     "dup_count"),
    "report_orphans": report_orphans,
    "report_bad_amount": report_bad_amount,
    "data_quality_report": data_quality_report,
    "profile_tables": profile_tables,
    "bronze_load_audit": bronze_load_audit,
    "silver_load_audit": silver_load_audit,
}
