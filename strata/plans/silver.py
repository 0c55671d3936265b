"""Silver layer: cleansed copies of the six bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleanse import (
    ERP_GENDER, GENDER, MARITAL, PRODUCT_LINE, map_codes, normalize_country, null_after,
    parse_int_date, reconcile_sales, repair_price, strip_prefix,
)
from strata.operators.dedup import dedup_latest
from strata.operators.scd2 import scd2_end_dates


def latest_customers(b: DataFrame) -> DataFrame:
    """Latest bronze row per cst_id; NULL ids are dropped before ranking.

    Newest create date first; ties go to the smallest key, then the other
    columns, so the pick is deterministic.
    """
    return dedup_latest(
        b.filter(F.col("cst_id").isNotNull()), ["cst_id"],
        [F.col("cst_create_date").desc_nulls_last(), F.col("cst_key").asc_nulls_first(),
         *[F.col(c).asc_nulls_first() for c in
           ("cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")]])


def crm_cust_info(b: DataFrame) -> DataFrame:
    """Latest row per cst_id, trimmed names, mapped codes."""
    latest = latest_customers(b)
    return latest.select(
        "cst_id", "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        map_codes("cst_marital_status", MARITAL).alias("cst_marital_status"),
        map_codes("cst_gndr", GENDER).alias("cst_gndr"),
        "cst_create_date")


def product_versions(b: DataFrame) -> DataFrame:
    """Bronze products with recomputed version end dates (source end discarded).

    Versions follow the *source* key (category included); equal starts are
    ordered by prd_id.
    """
    return scd2_end_dates(b.drop("prd_end_dt"), "prd_key", "prd_start_dt",
                          [F.col("prd_id").asc_nulls_first()], "prd_end_dt")


def crm_prd_info(b: DataFrame) -> DataFrame:
    """Split the key, default the cost, map the line, recompute version ends.

    The end date is computed before the key is cut.
    """
    ended = product_versions(b)
    return ended.select(
        "prd_id",
        F.replace(F.substring("prd_key", 1, 5), F.lit("-"), F.lit("_")).alias("cat_id"),
        F.substring("prd_key", 7, 1 << 30).alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        map_codes("prd_line", PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        "prd_end_dt")


def crm_sales_details(b: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Parse yyyymmdd integers, reconcile sales and price (row-local, no shuffle)."""
    sales, qty, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return b.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id",
        *[parse_int_date(c, strict_dates).alias(c)
          for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        reconcile_sales(sales, qty, price).alias("sls_sales"),
        "sls_quantity",
        repair_price(price, sales, qty).alias("sls_price"))


def erp_cust_az12(b: DataFrame, as_of: str) -> DataFrame:
    return b.select(
        strip_prefix("cid", "NAS").alias("cid"),
        null_after("bdate", as_of).alias("bdate"),
        map_codes("gen", ERP_GENDER).alias("gen"))


def erp_loc_a101(b: DataFrame) -> DataFrame:
    return b.select(F.replace(F.col("cid"), F.lit("-"), F.lit("")).alias("cid"),
                    normalize_country("cntry").alias("cntry"))


def erp_px_cat_g1v2(b: DataFrame) -> DataFrame:
    return b.select("id", "cat", "subcat", "maintenance")


def build(table: str, bronze: DataFrame, as_of: str, strict: bool = False) -> DataFrame:
    """Silver rows of ``table`` plus the load timestamp column.

    ``strict`` makes an eight-digit date that is no calendar date fail the
    load instead of becoming NULL.
    """
    rules = {
        "crm_cust_info": crm_cust_info,
        "crm_prd_info": crm_prd_info,
        "crm_sales_details": lambda b: crm_sales_details(b, strict),
        "erp_cust_az12": lambda b: erp_cust_az12(b, as_of),
        "erp_loc_a101": erp_loc_a101,
        "erp_px_cat_g1v2": erp_px_cat_g1v2,
    }
    return rules[table](bronze).withColumn("dwh_create_date", F.current_timestamp())
