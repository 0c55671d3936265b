import os

import pytest

from strata.schemas import BRONZE
from strata.sources.bronze import bronze_table, load_csv_table, quarantine_table
from strata.sources.csv import SOURCE_FILES, read_csv
from strata.sources.store import LayerStore


def _write(root, table, text):
    path = os.path.join(root, SOURCE_FILES[table])
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def _folder(root, table, files):
    path = os.path.join(root, SOURCE_FILES[table])
    os.makedirs(path, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(path, name), "wb") as fh:
            fh.write(text.encode() if isinstance(text, str) else text)
    return path


def test_columns_are_found_by_header_name(spark, tmpdir_path):
    """Every file of an extract has its own column order, quoting and case; a
    column that a file lacks is NULL; hidden and empty files are no data."""
    _folder(tmpdir_path, "crm_cust_info", {
        "a.csv": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
                 "1,AW1,An,One,S,F,2025-01-01\n",
        "b.csv": "cst_create_date,cst_gndr,cst_id,cst_lastname,cst_marital_status,cst_firstname,cst_key\r\n"
                 '2025-01-02,M,2,"Two, B",M,Bo,AW2\r\nnever,M,9,Nine,M,No,AW9\r\n',
        "c.csv": b"\xef\xbb\xbf" + '"CST_KEY", Cst_Id ,cst_firstname\nAW3,3,Cy\nAW4,4\n'.encode(),
        "d.csv": "cst_id,cst_key\n", "empty.csv": "", "_SUCCESS": "x", ".hidden.csv": "what,ever\n1,2\n"})
    store = LayerStore(spark)
    assert load_csv_table(store, tmpdir_path, "crm_cust_info") == (3, 2)
    rows = {r.cst_id: r for r in bronze_table(store, "crm_cust_info").collect()}
    assert tuple(rows[1])[:6] == (1, "AW1", "An", "One", "S", "F")
    assert tuple(rows[2])[:6] == (2, "AW2", "Bo", "Two, B", "M", "M")
    assert rows[2].cst_create_date.isoformat() == "2025-01-02"
    assert tuple(rows[3]) == (3, "AW3", "Cy", None, None, None, None)
    bad = sorted(r[0] for r in quarantine_table(store, "crm_cust_info").collect())
    assert bad == ["AW4,4", "never,M,9,Nine,M,No,AW9"]      # as the file has them


@pytest.mark.parametrize("header", ["cid,cntry,region", "cid,cid", "cntry,CID,cid", "cid;cntry"])
def test_unknown_or_repeated_column_is_an_error(spark, tmpdir_path, header):
    path = _folder(tmpdir_path, "erp_loc_a101", {"a.csv": "cid,cntry\nA,DE\n", "b.csv": header + "\nA,B,C\n"})
    with pytest.raises(ValueError, match="b.csv"):
        read_csv(spark, path, BRONZE["erp_loc_a101"])


def test_one_order_is_one_scan(spark, tmpdir_path):
    path = _folder(tmpdir_path, "erp_loc_a101", {f"{k}.csv": f"cntry,cid\nDE,A{k}\n" for k in range(40)})
    df = read_csv(spark, path, BRONZE["erp_loc_a101"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert sorted(r.cid for r in df.collect()) == sorted(f"A{k}" for k in range(40))
    other = _folder(tmpdir_path, "erp_loc_a101", {"x.csv": "cid,cntry\nX,FR\n"})
    df = read_csv(spark, other, BRONZE["erp_loc_a101"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert df.count() == 41 and df.filter("cntry = 'FR'").first().cid == "X"


def test_a_field_is_converted_once(spark, tmpdir_path):
    path = _write(tmpdir_path, "crm_sales_details", "sls_ord_num,sls_sales\nS,1\n")
    plan = read_csv(spark, path, BRONZE["crm_sales_details"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("try_cast(") == 1 and plan.count("trim(sls_sales") == 2  # the value; what failed


def test_csv_quarantine_nulls_text_crlf(spark, tmpdir_path):
    _write(tmpdir_path, "erp_px_cat_g1v2",
           "id,cat,subcat,maintenance\r\nAC_BR,Accessories,Bike Racks,Yes\r\n"
           "AC_BC,,n/a,No\r\n")
    _write(tmpdir_path, "crm_prd_info",
           "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\r\n"
           "210,CO-RF-FR-R92B,HL Road Frame,,R,2003-07-01,\r\n"
           "oops,CO-RF-FR-R92R,Frame,12,R,2003-07-01,\r\n")
    store = LayerStore(spark)
    assert load_csv_table(store, tmpdir_path, "erp_px_cat_g1v2") == (2, 0)
    rows = {r.id: r for r in bronze_table(store, "erp_px_cat_g1v2").collect()}
    assert rows["AC_BC"].cat is None and rows["AC_BC"].subcat == "n/a"
    assert rows["AC_BR"].maintenance == "Yes"            # no stray CR
    assert load_csv_table(store, tmpdir_path, "crm_prd_info") == (1, 1)
    good = bronze_table(store, "crm_prd_info").first()
    assert good.prd_id == 210 and good.prd_cost is None
    assert quarantine_table(store, "crm_prd_info").first()[0].startswith("oops,")


def test_csv_quotes_backslashes_and_null_markers(spark, tmpdir_path):
    """RFC 4180 quoting; a backslash is a character; NaN and NULL are NULL in
    number and date columns only."""
    _write(tmpdir_path, "erp_px_cat_g1v2",
           'id,cat,subcat,maintenance\n'
           'AC_BR,"Bike ""Pro"", Racks",x,Yes\n'
           'AC_BC,"ends with \\",y\\,"a,b"\n'
           'AC_BD,NaN,NULL,""\n')
    _write(tmpdir_path, "crm_prd_info",
           "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
           "1,K,NULL,NaN,R,2003-07-01,NULL\n"
           "2,K,n, 12 ,R,2003-07-01 10:00:00,\n"
           "3000000000,K,n,5,R,,\n"
           "4,K,n,5\n"
           "5,K,n,5,R,,,extra\n"
           '6,K,n,"1,2",R,never,\n')
    store = LayerStore(spark)
    assert load_csv_table(store, tmpdir_path, "erp_px_cat_g1v2") == (3, 0)
    rows = {r.id: r for r in bronze_table(store, "erp_px_cat_g1v2").collect()}
    assert rows["AC_BR"].cat == 'Bike "Pro", Racks' and rows["AC_BR"].maintenance == "Yes"
    assert rows["AC_BC"].cat == "ends with \\" and rows["AC_BC"].subcat == "y\\"
    assert rows["AC_BD"].cat == "NaN" and rows["AC_BD"].subcat == "NULL"
    assert rows["AC_BD"].maintenance is None
    assert load_csv_table(store, tmpdir_path, "crm_prd_info") == (3, 3)
    prd = {r.prd_id: r for r in bronze_table(store, "crm_prd_info").collect()}
    assert prd[1].prd_cost is None and prd[1].prd_nm == "NULL" and prd[1].prd_end_dt is None
    assert prd[2].prd_cost == 12 and prd[2].prd_start_dt.hour == 10 and 3000000000 in prd
    bad = sorted(r[0] for r in quarantine_table(store, "crm_prd_info").collect())
    assert bad == ["4,K,n,5", "5,K,n,5,R,,,extra", '6,K,n,"1,2",R,never,']


def test_csv_own_null_markers(spark, tmpdir_path):
    _write(tmpdir_path, "erp_loc_a101", "cid,cntry\nA,-\nB,?\nC,\nD,x\n")
    store = LayerStore(spark)
    load_csv_table(store, tmpdir_path, "erp_loc_a101", null_values=("-", "?"))
    assert {r.cid: r.cntry for r in bronze_table(store, "erp_loc_a101").collect()} == {
        "A": None, "B": None, "C": None, "D": "x"}


def test_csv_header_only_loads_no_rows(spark, tmpdir_path):
    _write(tmpdir_path, "erp_loc_a101", "cid,cntry\n")
    store = LayerStore(spark)
    assert load_csv_table(store, tmpdir_path, "erp_loc_a101") == (0, 0)
    assert bronze_table(store, "erp_loc_a101").columns == ["cid", "cntry"]
    assert bronze_table(store, "erp_loc_a101").count() == 0


def test_csv_strict_mode_fails(spark, tmpdir_path):
    path = _write(tmpdir_path, "erp_cust_az12", "cid,bdate,gen\nA,never,F\n")
    with pytest.raises(Exception, match="malformed line"):
        read_csv(spark, path, BRONZE["erp_cust_az12"], mode="FAILFAST").collect()


def test_csv_round_trip_keeps_text(spark, tmpdir_path):
    from strata.sources.csv import write_csv
    rows = [(' a"b" ', "x\\"), ("", None), (None, ",,"), ('""', "\\N"), ("é", "'")]
    df = spark.createDataFrame(rows, "cid string, cntry string")
    write_csv(df, f"{tmpdir_path}/t", "\\NULL")
    back = read_csv(spark, f"{tmpdir_path}/t", BRONZE["erp_loc_a101"], ("\\NULL",))
    got = sorted(((r.cid, r.cntry) for r in back.collect()), key=str)
    assert got == sorted(rows, key=str)


def test_warehouse_from_existing_extracts(spark, tmpdir_path):
    """Extracts written as plain CSV (empty field = NULL) load through the same path."""
    from strata.plans.warehouse import Warehouse
    from strata.schemas import TABLES
    from strata.sources.bronze import land_sources
    from strata.sources.fixtures import source_table
    sf = "/root/testdata/sf0.001"
    land_sources(spark, {t: source_table(spark, sf, t) for t in TABLES}, tmpdir_path, "")
    w = Warehouse.from_csv(spark, tmpdir_path)
    audit = {r.table_name: r.row_count for r in w.load_bronze().collect()}
    assert audit["crm_sales_details"] == 6000 and audit["crm_cust_info"] == 169
    assert audit["(all)"] == sum(n for t, n in audit.items() if t != "(all)")
    ref = Warehouse(spark, sf)
    # '' and NULL both mean "unknown" after cleansing, so silver and gold agree
    for t in ("crm_cust_info", "erp_loc_a101", "erp_cust_az12"):
        assert w.silver(t).exceptAll(ref.silver(t)).count() == 0
    assert w.gold("fact_sales").exceptAll(ref.gold("fact_sales")).count() == 0


def test_real_extracts_quarantine_in_audit(spark, tmpdir_path):
    """A malformed line in an extract is counted in the audit and kept out of bronze."""
    from strata.plans.warehouse import Warehouse
    from strata.schemas import TABLES
    from strata.sources.bronze import land_sources
    from strata.sources.fixtures import source_table
    sf = "/root/testdata/sf0.001"
    land_sources(spark, {t: source_table(spark, sf, t) for t in TABLES}, tmpdir_path, "")
    extra = os.path.join(tmpdir_path, SOURCE_FILES["crm_sales_details"], "part-extra.csv")
    with open(extra, "w") as fh:
        fh.write("sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
                 "sls_sales,sls_quantity,sls_price\n"
                 "SOBAD,P1,not-a-number,20200101,20200102,20200103,10,1,10\n")
    w = Warehouse.from_csv(spark, tmpdir_path)
    audit = {r.table_name: r for r in w.load_bronze().collect()}
    assert audit["crm_sales_details"].row_count == 6000
    assert audit["crm_sales_details"].quarantined == 1
    assert w.quarantine("crm_sales_details").first()[0].startswith("SOBAD,P1,not-a-number")
    assert w.bronze("crm_sales_details").filter("sls_ord_num = 'SOBAD'").count() == 0
