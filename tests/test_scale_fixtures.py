"""The derived extracts at key values far beyond the test tables."""

import duckdb
import pytest

from strata.schemas import BRONZE
from strata.sources.fixtures import FIXTURE_SQL, fixture_sql

PARTS = [10_000_000 + i for i in range(10)] + [300_000_000, 123_456_789_012]
CUSTS = [10**9, 10**9 + 1, 7, 99_999_999, 123_456_789_012]


def _tables(spark):
    import datetime as dt
    return {
        "part": spark.createDataFrame([(k, "p", "b", "LARGE", k % 50 + 1, 900.0) for k in PARTS],
                                      "p_partkey long, p_name string, p_brand string, p_type string, "
                                      "p_size int, p_retailprice double"),
        "customer": spark.createDataFrame([(k, "n", 1, 1.0, "seg") for k in CUSTS],
                                          "c_custkey long, c_name string, c_nationkey int, "
                                          "c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(1, "US", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "orders": spark.createDataFrame([(10**11, 10**9, dt.datetime(2000, 1, 1))],
                                        "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": spark.createDataFrame([(10**11, k, 1, 50.0, 5e11) for k in PARTS],
                                          "l_orderkey long, l_partkey long, l_linenumber int, "
                                          "l_quantity double, l_extendedprice double"),
    }


@pytest.mark.parametrize("table", sorted(FIXTURE_SQL))
def test_large_keys_stay_apart_and_do_not_overflow(spark, table):
    tables = _tables(spark)
    need = {n: t for n, t in tables.items() if f"{{{n}}}" in FIXTURE_SQL[table]}
    df = spark.sql(FIXTURE_SQL[table], **need)
    got = df.collect()
    assert [f.dataType for f in df.schema] == [f.dataType for f in BRONZE[table]]
    con = duckdb.connect()
    for n, t in need.items():
        con.register(n, t.toPandas())
    assert len(con.execute(fixture_sql(table)).fetchall()) == len(got)
    if table == "crm_prd_info":
        assert len({r.prd_key[6:] for r in got}) == len(PARTS)
        assert {r.prd_id // 10 for r in got} == set(PARTS)
    if table == "crm_cust_info":
        assert len({r.cst_key.strip() for r in got}) == len(CUSTS)
    if table == "crm_sales_details":
        assert len({r.sls_prd_key for r in got}) == len(PARTS)
        assert max(abs(r.sls_sales or 0) for r in got) > 2**31
    if table in ("erp_cust_az12", "erp_loc_a101"):
        assert len({r.cid.lstrip("NASWZ-") for r in got}) == len(CUSTS)


def test_no_row_of_the_tables_is_left_out(spark):
    from strata.sources.fixtures import driver_table, source_table
    sf = "/root/testdata/sf0.001"
    n = driver_table(spark, sf, "customer").count()
    for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101"):
        assert source_table(spark, sf, t).count() >= n
    sizes = driver_table(spark, sf, "part").selectExpr("p_size % 7 AS s").distinct().count()
    got = source_table(spark, sf, "erp_px_cat_g1v2").selectExpr("subcat").distinct().count()
    assert got == sizes
