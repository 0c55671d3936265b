"""Declared schemas of the bronze and silver layers (fixed DDL, no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

# Ids and amounts are bigint (the source declares INT): ids outgrow 32 bits,
# and a product of two amounts must not overflow.
S, I, L, D, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DateType(),
                  T.TimestampType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE = {
    "crm_cust_info": _struct(
        ("cst_id", L), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
        ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D)),
    "crm_prd_info": _struct(
        ("prd_id", L), ("prd_key", S), ("prd_nm", S), ("prd_cost", I), ("prd_line", S),
        ("prd_start_dt", TS), ("prd_end_dt", TS)),
    "crm_sales_details": _struct(
        ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L), ("sls_order_dt", I),
        ("sls_ship_dt", I), ("sls_due_dt", I), ("sls_sales", L), ("sls_quantity", L),
        ("sls_price", L)),
    "erp_loc_a101": _struct(("cid", S), ("cntry", S)),
    "erp_cust_az12": _struct(("cid", S), ("bdate", D), ("gen", S)),
    "erp_px_cat_g1v2": _struct(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

# Load order of the source procedures: CRM first, then ERP.
TABLES = ["crm_cust_info", "crm_prd_info", "crm_sales_details",
          "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"]

SILVER_COLUMNS = {
    "crm_cust_info": ["cst_id", "cst_key", "cst_firstname", "cst_lastname",
                      "cst_marital_status", "cst_gndr", "cst_create_date"],
    "crm_prd_info": ["prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_line",
                     "prd_start_dt", "prd_end_dt"],
    "crm_sales_details": ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt",
                          "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity",
                          "sls_price"],
    "erp_cust_az12": ["cid", "bdate", "gen"],
    "erp_loc_a101": ["cid", "cntry"],
    "erp_px_cat_g1v2": ["id", "cat", "subcat", "maintenance"],
}
