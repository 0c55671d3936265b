"""Row counts recorded independently for the sf0.001 fixtures (FIXTURES.md)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.plans.warehouse import warehouse

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

EXPECTED = {
    "bronze_crm_cust_info": 169, "bronze_crm_prd_info": 305, "bronze_crm_sales_details": 6000,
    "bronze_erp_cust_az12": 152, "bronze_erp_loc_a101": 150, "bronze_erp_px_cat_g1v2": 42,
    "silver_crm_cust_info": 149, "gold_dim_customers": 151, "gold_dim_products": 204,
    "gold_fact_sales": 6215, "check_cust_key_trim": 1, "check_prd_nm_trim": 1,
    "check_prd_cost": 4, "check_prd_date_order": 2, "check_due_dt_valid": 10,
    "check_sales_date_order": 15, "report_date_order": 15, "check_sales_consistency": 53,
    "check_bdate_range": 1, "check_px_cat_trim": 1, "check_orphans": 17, "report_orphans": 17,
    "report_bad_amount": 55, "revenue_trends": 80, "product_performance": 20, "kpi_summary": 1,
    "check_prd_id_unique": 4, "check_customer_id_unique": 2, "check_product_number_unique": 4,
    "check_cust_id_unique_violated": 22, "check_customer_key_unique_violated": 21,
    "check_product_key_unique_violated": 29, "product_performance_ties": 25,
}


@pytest.mark.parametrize("key,rows", sorted(EXPECTED.items()))
def test_expected_rows(spark, key, rows):
    assert E.queries()[key](spark, SF).count() == rows


def test_versions_ended_and_null_ids(spark):
    w = warehouse(spark, SF)
    assert w.silver("crm_prd_info").filter(F.col("prd_end_dt").isNotNull()).count() == 101
    r2 = {r.check_name: r.violation_count for r in E.queries()["report_bronze_null_keys"](spark, SF).collect()}
    assert r2["bronze.crm_cust_info — null cst_id"] == 1


def test_copies_and_quarantine_are_counted(spark):
    copies = {r.table_name: r.duplicates for r in E.queries()["profile_tables"](spark, SF).collect()}
    assert copies["crm_cust_info"] == 4
    bad = {r.table_name: r.quarantined for r in E.queries()["bronze_load_audit"](spark, SF).collect()}
    assert bad["crm_cust_info"] == bad["(all)"] == 3
