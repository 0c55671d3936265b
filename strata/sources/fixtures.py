"""Source tables derived from the driver's TPC-H-like parquet tables.

The warehouse's CSV extracts are not shipped, so the six source tables are
derived by SQL (FIXTURES.md).  The same text feeds Spark (driver tables bound
as DataFrame parameters) and the DuckDB oracle (plain view names), so both
sides start from identical rows.  ``{name}`` marks a driver table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def _pad(key: str, n: int) -> str:
    """``key`` as text with leading zeros to at least ``n`` digits; a longer
    key keeps all of its digits (a plain lpad would cut it)."""
    t = f"CAST({key} AS STRING)"
    return f"lpad({t}, CAST(greatest({n}, length({t})) AS INT), '0')"


# Rows whose key must find no partner get a key that nobody else has.
_CUST = _pad("c_custkey", 8)
_PART = _pad("p_partkey", 7)
_CATEGORY = "upper(substring(p_type, 1, 2))"

FIXTURE_SQL = {
    "crm_cust_info": f"""
SELECT CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE c_custkey END AS cst_id,
 CASE WHEN c_custkey % 500 = 11 THEN ' ' ELSE '' END || 'AW' || {_CUST} AS cst_key,
 CASE WHEN c_custkey % 3 = 0 THEN '  ' || c_mktsegment || ' ' ELSE c_mktsegment END AS cst_firstname,
 CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE 'Cust' || CAST(c_custkey AS STRING) END AS cst_lastname,
 CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN ' m ' WHEN 2 THEN 'M' ELSE NULL END AS cst_marital_status,
 CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN ' m' WHEN 2 THEN 'M' WHEN 3 THEN 'X' ELSE NULL END AS cst_gndr,
 DATE '2025-10-01' + CAST(c_custkey % 90 AS INT) AS cst_create_date
FROM {{customer}}
UNION ALL
SELECT c_custkey, 'AW' || {_CUST}, 'Old', 'Old', 'S', 'F',
 DATE '2025-08-01' + CAST(c_custkey % 30 AS INT)
FROM {{customer}} JOIN (SELECT 10 AS every UNION ALL SELECT 40) e ON c_custkey % every = 0
""",
    "crm_prd_info": f"""
SELECT p_partkey * 10 + v AS prd_id,
 {_CATEGORY} || '-' || lpad(CAST(p_size % 7 AS STRING), 2, '0') || '-P' || {_PART} AS prd_key,
 CASE WHEN p_partkey % 400 = 17 THEN ' ' ELSE '' END || p_name || ' ' || p_brand AS prd_nm,
 CASE WHEN p_partkey % 101 = 5 THEN NULL ELSE CASE WHEN p_partkey % 101 = 6 THEN -1 ELSE 1 END * (CAST(floor(p_retailprice / 2) AS INT) + v) END AS prd_cost,
 CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'R' WHEN 2 THEN 's' WHEN 3 THEN 'T' WHEN 4 THEN NULL ELSE 'Z' END AS prd_line,
 CAST(DATE '1994-01-01' + CAST(CASE WHEN p_partkey % 150 = 0 AND v = 1 THEN 0 ELSE v * 400 END + p_partkey % 30 AS INT) AS TIMESTAMP) AS prd_start_dt,
 CAST(NULL AS TIMESTAMP) AS prd_end_dt
FROM {{part}} CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) vs
WHERE v = 0 OR (v = 1 AND p_partkey % 3 = 0) OR (v = 2 AND p_partkey % 6 = 0)
UNION ALL
SELECT p_partkey * 10, 'ZZ-09-P' || {_PART}, p_name || ' again', 1, 'R', CAST(DATE '1994-03-01' AS TIMESTAMP),
 CAST(NULL AS TIMESTAMP)
FROM {{part}} WHERE p_partkey % 50 = 9
""",
    "crm_sales_details": f"""
SELECT 'SO' || CAST(l_orderkey AS STRING) AS sls_ord_num,
 CASE WHEN l_partkey % 401 = 400 THEN 'PX' ELSE 'P' || {_pad("l_partkey", 7)} END AS sls_prd_key,
 o_custkey AS sls_cust_id,
 CASE WHEN (l_orderkey + l_linenumber) % 211 = 0 THEN 0 WHEN (l_orderkey + l_linenumber) % 211 = 1 THEN 32154
      ELSE CAST((year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate)) AS INT) END AS sls_order_dt,
 CAST((year(ship)*10000+month(ship)*100+day(ship)) AS INT) AS sls_ship_dt,
 CASE WHEN (l_orderkey + l_linenumber) % 401 = 0 THEN 0 ELSE CAST((year(due)*10000+month(due)*100+day(due)) AS INT) END AS sls_due_dt,
 CASE (l_orderkey + l_linenumber) % 103 WHEN 0 THEN NULL WHEN 1 THEN -(q * p) WHEN 2 THEN q * p + 1 ELSE q * p END AS sls_sales,
 q AS sls_quantity,
 CASE (l_orderkey + l_partkey) % 107 WHEN 0 THEN NULL WHEN 1 THEN -p WHEN 2 THEN 0 ELSE p END AS sls_price
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS p,
        CAST(o_orderdate AS DATE) + CAST(CASE WHEN (l_orderkey + l_linenumber) % 307 = 0 THEN -3 ELSE 7 END AS INT) AS ship,
        CAST(o_orderdate AS DATE) + 12 AS due
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey) l
""",
    "erp_cust_az12": f"""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || CASE WHEN c_custkey % 40 = 39 THEN 'ZZ' ELSE 'AW' END || {_CUST} AS cid,
 CASE WHEN c_custkey % 200 = 3 THEN DATE '2099-01-01' WHEN c_custkey % 300 = 4 THEN DATE '1920-05-05'
      ELSE DATE '1950-01-01' + CAST(c_custkey * 13 % 18000 AS INT) END AS bdate,
 CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'Female' WHEN 2 THEN 'm ' WHEN 3 THEN ' MALE' WHEN 4 THEN NULL ELSE '' END AS gen
FROM {{customer}}
UNION ALL
SELECT 'AW' || {_CUST}, DATE '1960-06-06', 'F' FROM {{customer}} WHERE c_custkey % 75 = 5
""",
    "erp_loc_a101": f"""
SELECT CASE WHEN c_custkey % 60 = 59 THEN 'ZZ-' ELSE 'AW-' END || {_CUST} AS cid,
 CASE WHEN c_nationkey = 0 THEN 'DE' WHEN c_nationkey = 1 THEN 'US' WHEN c_nationkey = 2 THEN 'USA ' WHEN c_nationkey = 3 THEN ''
      WHEN c_nationkey = 4 THEN NULL WHEN c_nationkey = 5 THEN '  ' ELSE ' ' || n_name || ' ' END AS cntry
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
""",
    "erp_px_cat_g1v2": f"""
SELECT DISTINCT CASE WHEN p_size % 7 = 6 THEN 'ZZ' ELSE {_CATEGORY} END || '_' || lpad(CAST(p_size % 7 AS STRING), 2, '0') AS id,
 CASE WHEN p_type = 'LARGE' AND p_size % 7 = 3 THEN 'LARGE ' ELSE p_type END AS cat, 'Sub' || CAST(p_size % 7 AS STRING) AS subcat, CASE WHEN p_size % 7 % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance
FROM {{part}}
""",
}

# Lines that do not parse (text where a number belongs), landed beside the
# good ones in files with another column order: the loader must find the
# columns by name, quarantine the lines and count them.
MALFORMED_SQL = {
    "crm_cust_info": f"""
SELECT '2025-08-01' AS cst_create_date, 'AW' || {_CUST} AS cst_key, 'No, "really"' AS cst_firstname,
 'Body' AS cst_lastname, 'S' AS cst_marital_status, 'F' AS cst_gndr, 'id ' || CAST(c_custkey AS STRING) AS cst_id
FROM {{customer}} WHERE c_custkey % 50 = 1
""",
}

DRIVER_TABLES = {
    "crm_cust_info": ["customer"],
    "crm_prd_info": ["part"],
    "crm_sales_details": ["lineitem", "orders"],
    "erp_cust_az12": ["customer"],
    "erp_loc_a101": ["customer", "nation"],
    "erp_px_cat_g1v2": ["part"],
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def malformed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rows of text that do not fit their table's types, by table."""
    return {t: spark.sql(q, **{n: driver_table(spark, sf_dir, n) for n in DRIVER_TABLES[t]
                               if f"{{{n}}}" in q}) for t, q in MALFORMED_SQL.items()}


def malformed_sql(table: str) -> str | None:
    q = MALFORMED_SQL.get(table)
    return q and q.format(**{n: n for n in DRIVER_TABLES[table]}).strip()


def source_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the six source tables, derived lazily from the driver tables."""
    tables = {n: driver_table(spark, sf_dir, n) for n in DRIVER_TABLES[table]}
    return spark.sql(FIXTURE_SQL[table], **tables)


def fixture_sql(table: str) -> str:
    """The same derivation for an engine where driver tables are plain views."""
    return FIXTURE_SQL[table].format(**{n: n for n in DRIVER_TABLES[table]}).strip()
