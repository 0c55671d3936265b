"""Independent SQL statement of every registered query (DuckDB dialect).

Used as the correctness oracle: the driver runs these texts in DuckDB on the
same parquet tables and compares with the Spark results.  Each text starts
from the shared fixture derivation and restates silver, gold and the
analytics in plain SQL with the same tie-breakers and NULL ordering.
"""

from __future__ import annotations

from strata.schemas import TABLES
from strata.session import DEFAULT_AS_OF
from strata.sources.fixtures import fixture_sql, malformed_sql

AS_OF = f"DATE '{DEFAULT_AS_OF}'"


def ratio_sql(num: str, den: str, digits: int, scale: int = 100) -> str:
    """ROUND(scale * num / NULLIF(den, 0), digits), exact, half away from zero."""
    m = scale * 10 ** digits
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END) * "
            f"((abs({n}) * {2 * m} + abs({d})) // (2 * abs({d}))) AS DOUBLE) "
            f"/ CAST({10 ** digits} AS DOUBLE) END)")


def _date(col: str) -> str:
    return (f"CASE WHEN {col} = 0 OR length(CAST({col} AS VARCHAR)) <> 8 THEN NULL "
            f"ELSE CAST(try_strptime(CAST({col} AS VARCHAR), '%Y%m%d') AS DATE) END")


def _codes(col: str, pairs: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN upper(trim({col})) = '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {whens} ELSE 'n/a' END"


CTES: dict[str, tuple[str, list[str]]] = {}
for _t in TABLES:
    CTES[f"b_{_t}"] = (fixture_sql(_t), [])

CTES["s_crm_cust_info"] = (f"""
SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
  {_codes('cst_marital_status', [('S', 'Single'), ('M', 'Married')])} AS cst_marital_status,
  {_codes('cst_gndr', [('F', 'Female'), ('M', 'Male')])} AS cst_gndr,
  cst_create_date
FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC NULLS LAST,
        cst_key ASC NULLS FIRST, cst_firstname ASC NULLS FIRST, cst_lastname ASC NULLS FIRST,
        cst_marital_status ASC NULLS FIRST, cst_gndr ASC NULLS FIRST) AS flag_last
      FROM b_crm_cust_info WHERE cst_id IS NOT NULL) t
WHERE flag_last = 1""", ["b_crm_cust_info"])

CTES["s_crm_prd_info"] = (f"""
SELECT prd_id, replace(substring(src_key, 1, 5), '-', '_') AS cat_id, substring(src_key, 7) AS prd_key,
  prd_nm, coalesce(prd_cost, 0) AS prd_cost,
  {_codes('prd_line', [('M', 'Mountain'), ('R', 'Road'), ('S', 'Other Sales'), ('T', 'Touring')])} AS prd_line,
  CAST(prd_start_dt AS DATE) AS prd_start_dt,
  CAST(CAST(next_start AS DATE) - 1 AS DATE) AS prd_end_dt
FROM (SELECT prd_id, prd_key AS src_key, prd_nm, prd_cost, prd_line, prd_start_dt,
        lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt ASC NULLS FIRST,
                                 prd_id ASC NULLS FIRST) AS next_start
      FROM b_crm_prd_info) t""", ["b_crm_prd_info"])

CTES["s_crm_sales_details"] = (f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
  {_date('sls_order_dt')} AS sls_order_dt,
  {_date('sls_ship_dt')} AS sls_ship_dt,
  {_date('sls_due_dt')} AS sls_due_dt,
  CASE WHEN sls_sales IS NULL OR sls_sales <= 0 OR sls_sales <> sls_quantity * abs(sls_price)
       THEN sls_quantity * abs(sls_price) ELSE sls_sales END AS sls_sales,
  sls_quantity,
  CASE WHEN sls_price IS NULL OR sls_price <= 0
       THEN CAST(sls_sales // NULLIF(sls_quantity, 0) AS BIGINT) ELSE sls_price END AS sls_price
FROM b_crm_sales_details""", ["b_crm_sales_details"])

CTES["s_erp_cust_az12"] = (f"""
SELECT CASE WHEN cid LIKE 'NAS%' THEN substring(cid, 4) ELSE cid END AS cid,
  CASE WHEN bdate > {AS_OF} THEN NULL ELSE bdate END AS bdate,
  CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
       WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gen
FROM b_erp_cust_az12""", ["b_erp_cust_az12"])

CTES["s_erp_loc_a101"] = ("""
SELECT replace(cid, '-', '') AS cid,
  CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
       WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
       WHEN trim(cntry) = '' OR cntry IS NULL THEN 'n/a'
       ELSE trim(cntry) END AS cntry
FROM b_erp_loc_a101""", ["b_erp_loc_a101"])

CTES["s_erp_px_cat_g1v2"] = ("SELECT id, cat, subcat, maintenance FROM b_erp_px_cat_g1v2",
                             ["b_erp_px_cat_g1v2"])

CTES["g_dim_customers"] = ("""
SELECT CAST(row_number() OVER (ORDER BY ci.cst_id ASC NULLS FIRST, ci.cst_key ASC NULLS FIRST,
         ca.bdate ASC NULLS FIRST, ca.gen ASC NULLS FIRST, la.cntry ASC NULLS FIRST) AS BIGINT) AS customer_key,
  ci.cst_id AS customer_id, ci.cst_key AS customer_number, ci.cst_firstname AS first_name,
  ci.cst_lastname AS last_name, la.cntry AS country, ci.cst_marital_status AS marital_status,
  CASE WHEN ci.cst_gndr <> 'n/a' THEN ci.cst_gndr ELSE coalesce(ca.gen, 'n/a') END AS gender,
  ca.bdate AS birthdate, ci.cst_create_date AS create_date
FROM s_crm_cust_info ci
LEFT JOIN s_erp_cust_az12 ca ON ci.cst_key = ca.cid
LEFT JOIN s_erp_loc_a101 la ON ci.cst_key = la.cid""",
                           ["s_crm_cust_info", "s_erp_cust_az12", "s_erp_loc_a101"])

CTES["g_dim_products"] = ("""
SELECT CAST(row_number() OVER (ORDER BY pn.prd_start_dt ASC NULLS FIRST, pn.prd_key ASC NULLS FIRST,
         pn.prd_id ASC NULLS FIRST) AS BIGINT) AS product_key,
  pn.prd_id AS product_id, pn.prd_key AS product_number, pn.prd_nm AS product_name,
  pn.cat_id AS category_id, pc.cat AS category, pc.subcat AS subcategory,
  pc.maintenance AS maintenance, pn.prd_cost AS cost, pn.prd_line AS product_line,
  pn.prd_start_dt AS start_date
FROM s_crm_prd_info pn
LEFT JOIN s_erp_px_cat_g1v2 pc ON pn.cat_id = pc.id
WHERE pn.prd_end_dt IS NULL""", ["s_crm_prd_info", "s_erp_px_cat_g1v2"])

CTES["g_fact_sales"] = ("""
SELECT sd.sls_ord_num AS order_number, pr.product_key, cu.customer_key,
  sd.sls_order_dt AS order_date, sd.sls_ship_dt AS shipping_date, sd.sls_due_dt AS due_date,
  sd.sls_sales AS sales_amount, sd.sls_quantity AS quantity, sd.sls_price AS price
FROM s_crm_sales_details sd
LEFT JOIN g_dim_products pr ON sd.sls_prd_key = pr.product_number
LEFT JOIN g_dim_customers cu ON sd.sls_cust_id = cu.customer_id""",
                        ["s_crm_sales_details", "g_dim_products", "g_dim_customers"])

CTES["a_monthly"] = ("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start,
  CAST(sum(sales_amount) AS BIGINT) AS revenue,
  count(DISTINCT order_number) AS order_count,
  count(DISTINCT customer_key) AS unique_customers
FROM g_fact_sales WHERE order_date IS NOT NULL
GROUP BY 1""", ["g_fact_sales"])

CTES["a_rfm_raw"] = (f"""
SELECT c.customer_id, c.first_name, c.last_name, c.first_name || ' ' || c.last_name AS customer_name,
  c.country, max(f.order_date) AS last_order_date,
  CAST(date_diff('day', max(f.order_date), {AS_OF}) AS BIGINT) AS recency_days,
  count(DISTINCT f.order_number) AS frequency,
  CAST(sum(f.sales_amount) AS BIGINT) AS monetary
FROM g_fact_sales f JOIN g_dim_customers c ON c.customer_key = f.customer_key
WHERE f.order_date IS NOT NULL
GROUP BY c.customer_id, c.first_name, c.last_name, c.country""",
                     ["g_fact_sales", "g_dim_customers"])

_TIE = ("customer_id ASC NULLS FIRST, country ASC NULLS FIRST, first_name ASC NULLS FIRST, "
        "last_name ASC NULLS FIRST")


def _rfm_scores(r: str, f: str, m: str) -> str:
    return f"""
SELECT *,
  CAST(ntile(5) OVER (ORDER BY {r}, {_TIE}) AS BIGINT) AS r_score,
  CAST(ntile(5) OVER (ORDER BY {f}, {_TIE}) AS BIGINT) AS f_score,
  CAST(ntile(5) OVER (ORDER BY {m}, {_TIE}) AS BIGINT) AS m_score
FROM a_rfm_raw"""


CTES["a_rfm_scores"] = (_rfm_scores("recency_days ASC NULLS FIRST", "frequency DESC NULLS LAST",
                                    "monetary DESC NULLS LAST"), ["a_rfm_raw"])
CTES["a_rfm_scores_best_high"] = (_rfm_scores("recency_days DESC NULLS LAST",
                                              "frequency ASC NULLS FIRST",
                                              "monetary ASC NULLS FIRST"), ["a_rfm_raw"])


def _rfm_final(scores: str) -> str:
    return f"""
SELECT customer_id, customer_name, country, last_order_date, recency_days, frequency,
  monetary AS lifetime_value, r_score, f_score, m_score, rfm_total,
  CASE WHEN rfm_total >= 13 THEN 'Champions' WHEN rfm_total >= 10 THEN 'Loyal'
       WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN rfm_total <= 6 THEN 'Lost'
       ELSE 'Potential' END AS segment
FROM (SELECT *, r_score + f_score + m_score AS rfm_total FROM {scores}) c
ORDER BY rfm_total DESC"""


CTES["a_product_sales"] = ("""
SELECT p.product_name, p.category, p.subcategory, p.product_line,
  CAST(sum(f.sales_amount) AS BIGINT) AS total_revenue,
  CAST(sum(f.quantity) AS BIGINT) AS units_sold,
  count(DISTINCT f.order_number) AS order_count,
  CAST(sum(f.price) // NULLIF(count(f.price), 0) AS BIGINT) AS avg_selling_price,
  p.cost AS unit_cost
FROM g_fact_sales f JOIN g_dim_products p ON p.product_key = f.product_key
WHERE f.order_date IS NOT NULL
GROUP BY p.product_name, p.category, p.subcategory, p.product_line, p.cost""",
                           ["g_fact_sales", "g_dim_products"])

CTES["a_product_ranked"] = (f"""
SELECT *,
  {ratio_sql('total_revenue', 'sum(total_revenue) OVER ()', 2)} AS pct_of_total,
  CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank,
  {ratio_sql('avg_selling_price - unit_cost', 'avg_selling_price', 1)} AS est_margin_pct
FROM a_product_sales""", ["a_product_sales"])

CTES["a_sales_base"] = ("""
SELECT f.order_number, f.order_date, f.sales_amount, f.quantity, p.product_name, c.country
FROM g_fact_sales f
JOIN g_dim_products p ON p.product_key = f.product_key
JOIN g_dim_customers c ON c.customer_key = f.customer_key
WHERE f.order_date IS NOT NULL""", ["g_fact_sales", "g_dim_products", "g_dim_customers"])


def with_ctes(final: str, deps: list[str]) -> str:
    """Prefix ``final`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in CTES[name][1]:
            visit(d)
        order.append(name)

    for d in deps:
        visit(d)
    body = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    return f"WITH {body}\n{final.strip()}"


QUERIES: dict[str, str] = {}


def _q(key: str, final: str, deps: list[str]) -> None:
    QUERIES[key] = with_ctes(final, deps)


# ---- bronze and silver tables (silver without the load timestamp)
from strata.schemas import SILVER_COLUMNS  # noqa: E402

for _t in TABLES:
    _q(f"bronze_{_t}", f"SELECT * FROM b_{_t}", [f"b_{_t}"])
    _q(f"silver_{_t}", f"SELECT {', '.join(SILVER_COLUMNS[_t])} FROM s_{_t}", [f"s_{_t}"])

for _g in ("dim_customers", "dim_products", "fact_sales"):
    _q(f"gold_{_g}", f"SELECT * FROM g_{_g}", [f"g_{_g}"])

_q("revenue_trends", f"""
SELECT month_start, strftime(month_start, '%b %Y') AS month_label, revenue, order_count,
  unique_customers,
  {ratio_sql('revenue - prev_revenue', 'prev_revenue', 2)} AS mom_growth_pct,
  CAST(sum(revenue) OVER w // NULLIF(count(revenue) OVER w, 0) AS BIGINT) AS rolling_3m_avg
FROM (SELECT *, lag(revenue) OVER (ORDER BY month_start) AS prev_revenue FROM a_monthly) t
WINDOW w AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
ORDER BY month_start""", ["a_monthly"])

_q("monthly_revenue", "SELECT * FROM a_monthly", ["a_monthly"])

_q("rfm_raw", """
SELECT customer_id, customer_name, country, last_order_date, recency_days, frequency, monetary
FROM a_rfm_raw""", ["a_rfm_raw"])

_q("rfm_segmentation", _rfm_final("a_rfm_scores"), ["a_rfm_scores"])
_q("rfm_segmentation_best_high", _rfm_final("a_rfm_scores_best_high"), ["a_rfm_scores_best_high"])
_q("rfm_scores", """SELECT customer_id, customer_name, country, last_order_date, recency_days,
  frequency, monetary, r_score, f_score, m_score FROM a_rfm_scores""", ["a_rfm_scores"])

_q("dedup_latest", """
SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, cst_create_date
FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC NULLS LAST,
        cst_key ASC NULLS FIRST, cst_firstname ASC NULLS FIRST, cst_lastname ASC NULLS FIRST,
        cst_marital_status ASC NULLS FIRST, cst_gndr ASC NULLS FIRST) AS flag_last
      FROM b_crm_cust_info WHERE cst_id IS NOT NULL) t
WHERE flag_last = 1""", ["b_crm_cust_info"])
_q("scd2_end_dates", """
SELECT prd_id, prd_key, CAST(prd_start_dt AS DATE) AS prd_start_dt,
  CAST(CAST(lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt ASC NULLS FIRST,
       prd_id ASC NULLS FIRST) AS DATE) - 1 AS DATE) AS prd_end_dt
FROM b_crm_prd_info""", ["b_crm_prd_info"])
_q("parse_int_dates", "SELECT sls_ord_num, sls_prd_key, " + ", ".join(
    f"sls_{c}_dt AS sls_{c}_int, {_date(f'sls_{c}_dt')} AS sls_{c}_dt"
    for c in ("order", "ship", "due")) + " FROM b_crm_sales_details", ["b_crm_sales_details"])
for _key, _label in (("best_month", "strftime(order_date, '%b %Y')"),
                     ("top_product", "product_name"), ("top_country", "country")):
    _name = {"best_month": "month_label"}.get(_key, _label)
    _q(_key, f"""SELECT {_label} AS {_name}, CAST(sum(sales_amount) AS BIGINT) AS rev
FROM a_sales_base GROUP BY 1 ORDER BY rev DESC NULLS LAST, {_name} ASC NULLS FIRST LIMIT 1""",
       ["a_sales_base"])

_q("product_sales", "SELECT * FROM a_product_sales", ["a_product_sales"])
_q("product_ranked", "SELECT * FROM a_product_ranked", ["a_product_ranked"])

_PP_COLS = ("product_name, category, subcategory, product_line, total_revenue, units_sold, "
            "order_count, avg_selling_price, unit_cost, pct_of_total, revenue_rank, est_margin_pct")
_q("product_performance", f"""
SELECT 'Top 10' AS tier, {_PP_COLS} FROM a_product_ranked WHERE revenue_rank <= 10
UNION ALL
SELECT 'Bottom 10' AS tier, {_PP_COLS} FROM a_product_ranked
WHERE revenue_rank > (SELECT count(*) FROM a_product_ranked) - 10 AND total_revenue > 0
ORDER BY tier DESC, revenue_rank""", ["a_product_ranked"])

_q("kpi_summary", f"""
SELECT CAST(sum(s.sales_amount) AS BIGINT) AS total_revenue,
  CAST(sum(s.sales_amount) // NULLIF(count(DISTINCT s.order_number), 0) AS BIGINT) AS avg_order_value,
  count(DISTINCT s.order_number) AS total_orders,
  count(DISTINCT c.customer_key) AS unique_customers,
  {ratio_sql('sum(s.quantity)', 'count(DISTINCT s.order_number)', 1, scale=1)} AS avg_items_per_order,
  (SELECT month_label FROM (SELECT strftime(order_date, '%b %Y') AS month_label, sum(sales_amount) AS rev
     FROM a_sales_base GROUP BY 1) m ORDER BY rev DESC NULLS LAST, month_label ASC NULLS FIRST LIMIT 1) AS best_sales_month,
  (SELECT product_name FROM a_sales_base GROUP BY product_name
     ORDER BY sum(sales_amount) DESC NULLS LAST, product_name ASC NULLS FIRST LIMIT 1) AS top_product,
  (SELECT country FROM a_sales_base GROUP BY country
     ORDER BY sum(sales_amount) DESC NULLS LAST, country ASC NULLS FIRST LIMIT 1) AS top_country
FROM g_fact_sales s JOIN g_dim_customers c ON c.customer_key = s.customer_key
WHERE s.order_date IS NOT NULL""", ["g_fact_sales", "g_dim_customers", "a_sales_base"])


# ---- quality checks
def _s(t: str) -> str:
    return ", ".join(SILVER_COLUMNS[t])


_DUE = ("sls_due_dt <= 0 OR length(CAST(sls_due_dt AS VARCHAR)) <> 8 OR sls_due_dt > 20500101 "
        "OR sls_due_dt < 19000101")
_ORDER = "sls_order_dt > sls_ship_dt OR sls_order_dt > sls_due_dt"
_NULLS = ("sls_sales IS NULL OR sls_quantity IS NULL OR sls_price IS NULL OR sls_sales <= 0 "
          "OR sls_quantity <= 0 OR sls_price <= 0")
_AMOUNTS = f"sls_sales <> sls_quantity * sls_price OR {_NULLS}"
_AMOUNTS_TOL = f"abs(sls_sales - sls_quantity * sls_price) > 1 OR {_NULLS}"
_BDATE = f"bdate < DATE '1924-01-01' OR bdate > {AS_OF}"
_COST = "prd_cost < 0 OR prd_cost IS NULL"
_DC = ["customer_key", "customer_id", "customer_number", "first_name", "last_name", "country",
       "marital_status", "gender", "birthdate", "create_date"]
_DP = ["product_key", "product_id", "product_number", "product_name", "category_id", "category",
       "subcategory", "maintenance", "cost", "product_line", "start_date"]
_ORPHANS = ("FROM g_fact_sales f LEFT JOIN g_dim_customers c ON c.customer_key = f.customer_key "
            "LEFT JOIN g_dim_products p ON p.product_key = f.product_key "
            "WHERE p.product_key IS NULL OR c.customer_key IS NULL")
_GOLD = ["g_fact_sales", "g_dim_customers", "g_dim_products"]

_q("check_cust_id_unique", """SELECT cst_id, count(*) AS row_count FROM s_crm_cust_info
GROUP BY cst_id HAVING count(*) > 1 OR cst_id IS NULL""", ["s_crm_cust_info"])
_q("check_cust_key_trim", "SELECT cst_key FROM s_crm_cust_info WHERE cst_key <> trim(cst_key)",
   ["s_crm_cust_info"])
_q("domain_marital_status", "SELECT DISTINCT cst_marital_status FROM s_crm_cust_info",
   ["s_crm_cust_info"])
_q("check_prd_id_unique", """SELECT prd_id, count(*) AS row_count FROM s_crm_prd_info
GROUP BY prd_id HAVING count(*) > 1 OR prd_id IS NULL""", ["s_crm_prd_info"])
_q("check_prd_nm_trim", "SELECT prd_nm FROM s_crm_prd_info WHERE prd_nm <> trim(prd_nm)",
   ["s_crm_prd_info"])
_q("check_prd_cost", f"SELECT prd_cost FROM s_crm_prd_info WHERE {_COST}", ["s_crm_prd_info"])
_q("domain_prd_line", "SELECT DISTINCT prd_line FROM s_crm_prd_info", ["s_crm_prd_info"])
_q("check_prd_date_order", f"SELECT {_s('crm_prd_info')} FROM s_crm_prd_info "
   "WHERE prd_end_dt < prd_start_dt", ["s_crm_prd_info"])
_q("check_due_dt_valid", f"SELECT NULLIF(sls_due_dt, 0) AS sls_due_dt FROM b_crm_sales_details "
   f"WHERE {_DUE}", ["b_crm_sales_details"])
_q("check_sales_date_order", f"SELECT {_s('crm_sales_details')} FROM s_crm_sales_details "
   f"WHERE {_ORDER}", ["s_crm_sales_details"])
_q("check_sales_consistency", f"""SELECT DISTINCT sls_sales, sls_quantity, sls_price
FROM s_crm_sales_details WHERE {_AMOUNTS}
ORDER BY sls_sales NULLS FIRST, sls_quantity NULLS FIRST, sls_price NULLS FIRST""",
   ["s_crm_sales_details"])
_q("check_bdate_range", f"SELECT DISTINCT bdate FROM s_erp_cust_az12 WHERE {_BDATE}",
   ["s_erp_cust_az12"])
_q("domain_gen", "SELECT DISTINCT gen FROM s_erp_cust_az12", ["s_erp_cust_az12"])
_q("domain_cntry", "SELECT DISTINCT cntry FROM s_erp_loc_a101 ORDER BY cntry NULLS FIRST",
   ["s_erp_loc_a101"])
_q("check_px_cat_trim", """SELECT id, cat, subcat, maintenance FROM s_erp_px_cat_g1v2
WHERE cat <> trim(cat) OR subcat <> trim(subcat) OR maintenance <> trim(maintenance)""",
   ["s_erp_px_cat_g1v2"])
_q("domain_maintenance", "SELECT DISTINCT maintenance FROM s_erp_px_cat_g1v2",
   ["s_erp_px_cat_g1v2"])
for _key, _tab, _cnt in (("customer_key", "g_dim_customers", "duplicate_count"),
                         ("product_key", "g_dim_products", "duplicate_count"),
                         ("customer_id", "g_dim_customers", "duplicate_count"),
                         ("product_number", "g_dim_products", "duplicate_count")):
    _q(f"check_{_key}_unique", f"SELECT {_key}, count(*) AS {_cnt} FROM {_tab} "
       f"GROUP BY {_key} HAVING count(*) > 1", [_tab])
_q("check_orphans", "SELECT f.*, " + ", ".join([f"c.{c} AS c_{c}" for c in _DC]
                                                 + [f"p.{c} AS p_{c}" for c in _DP])
   + " " + _ORPHANS, _GOLD)

_q("report_bronze_counts", " UNION ALL ".join(
    f"SELECT 'bronze.{t}' AS table_name, count(*) AS row_count FROM b_{t}" for t in TABLES),
   [f"b_{t}" for t in TABLES])
_q("report_bronze_null_keys", """
SELECT 'bronze.crm_cust_info — null cst_id' AS check_name, count(*) AS violation_count
FROM b_crm_cust_info WHERE cst_id IS NULL
UNION ALL
SELECT 'bronze.crm_sales_details — null order num', count(*)
FROM b_crm_sales_details WHERE sls_ord_num IS NULL""", ["b_crm_cust_info", "b_crm_sales_details"])
_q("report_dup_cust", """SELECT cst_id, count(*) AS duplicate_count FROM s_crm_cust_info
GROUP BY cst_id HAVING count(*) > 1""", ["s_crm_cust_info"])
_q("report_bad_cost", f"SELECT prd_id, prd_nm, prd_cost FROM s_crm_prd_info WHERE {_COST}",
   ["s_crm_prd_info"])
_q("report_sales_mismatch", f"""SELECT sls_ord_num, sls_quantity, sls_price, sls_sales,
  sls_quantity * sls_price AS expected_sales
FROM s_crm_sales_details WHERE {_AMOUNTS_TOL}""", ["s_crm_sales_details"])
_q("report_date_order", f"""SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt
FROM s_crm_sales_details WHERE {_ORDER}""", ["s_crm_sales_details"])
_q("report_bdate", f"SELECT cid, bdate FROM s_erp_cust_az12 WHERE {_BDATE}", ["s_erp_cust_az12"])
_q("report_whitespace", """
SELECT 'crm_cust_info — cst_key has leading/trailing space' AS issue, count(*) AS cnt
FROM s_crm_cust_info WHERE cst_key <> trim(cst_key)
UNION ALL
SELECT 'crm_prd_info — prd_nm has leading/trailing space', count(*)
FROM s_crm_prd_info WHERE prd_nm <> trim(prd_nm)""", ["s_crm_cust_info", "s_crm_prd_info"])
_q("report_domains", """
SELECT DISTINCT 'cst_gndr' AS column_name, cst_gndr AS value FROM s_crm_cust_info
UNION ALL SELECT DISTINCT 'cst_marital_status', cst_marital_status FROM s_crm_cust_info
UNION ALL SELECT DISTINCT 'gen', gen FROM s_erp_cust_az12""", ["s_crm_cust_info", "s_erp_cust_az12"])
_q("report_countries", "SELECT DISTINCT cntry FROM s_erp_loc_a101 ORDER BY cntry NULLS FIRST",
   ["s_erp_loc_a101"])
_q("report_dup_customer_key", """SELECT customer_key, count(*) AS dup_count FROM g_dim_customers
GROUP BY customer_key HAVING count(*) > 1""", ["g_dim_customers"])
_q("report_dup_product_key", """SELECT product_key, count(*) AS dup_count FROM g_dim_products
GROUP BY product_key HAVING count(*) > 1""", ["g_dim_products"])
_q("report_orphans", """SELECT f.order_number, f.customer_key, f.product_key,
  CASE WHEN c.customer_key IS NULL THEN 'Missing customer' ELSE '' END AS customer_issue,
  CASE WHEN p.product_key IS NULL THEN 'Missing product' ELSE '' END AS product_issue
""" + _ORPHANS, _GOLD)
_q("report_bad_amount", """SELECT order_number, sales_amount FROM g_fact_sales
WHERE sales_amount <= 0 OR sales_amount IS NULL""", ["g_fact_sales"])

_REPORT = [
    ("bronze", "null_cst_id", "SELECT count(*) FROM b_crm_cust_info WHERE cst_id IS NULL"),
    ("bronze", "null_sls_ord_num", "SELECT count(*) FROM b_crm_sales_details WHERE sls_ord_num IS NULL"),
    ("silver", "duplicate_cst_id", "SELECT count(*) FROM (SELECT cst_id FROM s_crm_cust_info "
     "GROUP BY cst_id HAVING count(*) > 1) d"),
    ("silver", "cst_key_whitespace", "SELECT count(*) FROM s_crm_cust_info WHERE cst_key <> trim(cst_key)"),
    ("silver", "bad_prd_cost", f"SELECT count(*) FROM s_crm_prd_info WHERE {_COST}"),
    ("silver", "prd_nm_whitespace", "SELECT count(*) FROM s_crm_prd_info WHERE prd_nm <> trim(prd_nm)"),
    ("silver", "sales_mismatch", f"SELECT count(*) FROM s_crm_sales_details WHERE {_AMOUNTS_TOL}"),
    ("silver", "order_after_ship_or_due", f"SELECT count(*) FROM s_crm_sales_details WHERE {_ORDER}"),
    ("silver", "bdate_out_of_range", f"SELECT count(*) FROM s_erp_cust_az12 WHERE {_BDATE}"),
    ("gold", "duplicate_customer_key", "SELECT count(*) FROM (SELECT customer_key FROM g_dim_customers "
     "GROUP BY customer_key HAVING count(*) > 1) d"),
    ("gold", "duplicate_product_key", "SELECT count(*) FROM (SELECT product_key FROM g_dim_products "
     "GROUP BY product_key HAVING count(*) > 1) d"),
    ("gold", "orphan_fact_rows", f"SELECT count(*) {_ORPHANS}"),
    ("gold", "bad_sales_amount", "SELECT count(*) FROM g_fact_sales WHERE sales_amount <= 0 "
     "OR sales_amount IS NULL"),
]
_q("data_quality_report", "SELECT layer, check_name, violations, violations = 0 AS passed, "
   f"'{DEFAULT_AS_OF} 00:00:00' AS run_date FROM ("
   + " UNION ALL ".join(f"SELECT '{lay}' AS layer, '{n}' AS check_name, ({s}) AS violations"
                        for lay, n, s in _REPORT) + ") r",
   [f"b_{t}" for t in TABLES] + [f"s_{t}" for t in TABLES] + _GOLD)


def _profile(t: str) -> str:
    from strata.schemas import BRONZE
    cols = [f.name for f in BRONZE[t].fields]
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    n = len(cols)
    return (f"SELECT '{t}' AS table_name, count(*) AS row_count, ({nulls}) AS null_cells, "
            f"CASE WHEN count(*) * {n} > 0 THEN CAST(100 AS DOUBLE) * ({nulls}) / (count(*) * {n}) "
            f"ELSE 0.0 END AS null_pct, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b_{t}) d) AS duplicates "
            f"FROM b_{t}")


_q("profile_tables", " UNION ALL ".join(_profile(t) for t in TABLES), [f"b_{t}" for t in TABLES])


def _quarantined(t: str) -> str:
    q = malformed_sql(t)
    return f"(SELECT count(*) FROM ({q}) q)" if q else "CAST(0 AS BIGINT)"


def _audit(layer: str, prefix: str, bad) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count, "
        f"{bad(t)} AS quarantined, 'loaded' AS status FROM {prefix}_{t}" for t in TABLES)
    return (f"SELECT * FROM ({rows}) a UNION ALL SELECT '{layer}', '(all)', "
            f"CAST(sum(row_count) AS BIGINT), CAST(sum(quarantined) AS BIGINT), 'loaded' FROM ({rows}) b")


_q("bronze_load_audit", _audit("bronze", "b", _quarantined), [f"b_{t}" for t in TABLES])
_q("silver_load_audit", _audit("silver", "s", lambda t: "CAST(0 AS BIGINT)"),
   [f"s_{t}" for t in TABLES])


# ---- the same checks over frames that hold violations (some rows twice)
for _key, _col, _tab, _cnt, _null in (
        ("check_cust_id_unique", "cst_id", "s_crm_cust_info", "row_count", " OR cst_id IS NULL"),
        ("check_customer_key_unique", "customer_key", "g_dim_customers", "duplicate_count", ""),
        ("check_product_key_unique", "product_key", "g_dim_products", "duplicate_count", ""),
        ("report_dup_cust", "cst_id", "s_crm_cust_info", "duplicate_count", ""),
        ("report_dup_customer_key", "customer_key", "g_dim_customers", "dup_count", ""),
        ("report_dup_product_key", "product_key", "g_dim_products", "dup_count", "")):
    _q(f"{_key}_violated", f"SELECT {_col}, count(*) AS {_cnt} FROM (SELECT {_col} FROM {_tab} "
       f"UNION ALL SELECT {_col} FROM {_tab} WHERE {_col} % 7 = 0) d "
       f"GROUP BY {_col} HAVING count(*) > 1{_null}", [_tab])

CTES["a_product_ties"] = (f"""
SELECT *,
  {ratio_sql('total_revenue', 'sum(total_revenue) OVER ()', 2)} AS pct_of_total,
  CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank,
  {ratio_sql('avg_selling_price - unit_cost', 'avg_selling_price', 1)} AS est_margin_pct
FROM (SELECT * REPLACE (CAST(total_revenue // 100000 AS BIGINT) AS total_revenue) FROM a_product_sales) t""",
                          ["a_product_sales"])
_q("product_performance_ties", f"""
SELECT 'Top 10' AS tier, {_PP_COLS} FROM a_product_ties WHERE revenue_rank <= 10
UNION ALL
SELECT 'Bottom 10' AS tier, {_PP_COLS} FROM a_product_ties
WHERE revenue_rank > (SELECT count(*) FROM a_product_ties) - 10 AND total_revenue > 0""",
   ["a_product_ties"])


# ---- exact variants (decimals kept where the source engine averaged integers)
CTES["a_product_sales_exact"] = (f"""
SELECT p.product_name, p.category, p.subcategory, p.product_line,
  CAST(sum(f.sales_amount) AS BIGINT) AS total_revenue,
  CAST(sum(f.quantity) AS BIGINT) AS units_sold,
  count(DISTINCT f.order_number) AS order_count,
  {ratio_sql('sum(f.price)', 'count(f.price)', 2, scale=1)} AS avg_selling_price,
  p.cost AS unit_cost
FROM g_fact_sales f JOIN g_dim_products p ON p.product_key = f.product_key
WHERE f.order_date IS NOT NULL
GROUP BY p.product_name, p.category, p.subcategory, p.product_line, p.cost""",
                                 ["g_fact_sales", "g_dim_products"])
CTES["a_product_ranked_exact"] = (f"""
SELECT *,
  {ratio_sql('total_revenue', 'sum(total_revenue) OVER ()', 2)} AS pct_of_total,
  CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank,
  {ratio_sql('round(avg_selling_price * 100) - unit_cost * 100', 'round(avg_selling_price * 100)', 1)} AS est_margin_pct
FROM a_product_sales_exact""", ["a_product_sales_exact"])

_q("product_performance_exact", f"""
SELECT 'Top 10' AS tier, {_PP_COLS} FROM a_product_ranked_exact WHERE revenue_rank <= 10
UNION ALL
SELECT 'Bottom 10' AS tier, {_PP_COLS} FROM a_product_ranked_exact
WHERE revenue_rank > (SELECT count(*) FROM a_product_ranked_exact) - 10 AND total_revenue > 0
ORDER BY tier DESC, revenue_rank""", ["a_product_ranked_exact"])

_TREND_EXACT = QUERIES["revenue_trends"].replace(
    "CAST(sum(revenue) OVER w // NULLIF(count(revenue) OVER w, 0) AS BIGINT)",
    ratio_sql("sum(revenue) OVER w", "count(revenue) OVER w", 2, scale=1))
assert _TREND_EXACT != QUERIES["revenue_trends"]
QUERIES["revenue_trends_exact"] = _TREND_EXACT

_KPI_EXACT = QUERIES["kpi_summary"].replace(
    "CAST(sum(s.sales_amount) // NULLIF(count(DISTINCT s.order_number), 0) AS BIGINT)",
    ratio_sql("sum(s.sales_amount)", "count(DISTINCT s.order_number)", 2, scale=1))
assert _KPI_EXACT != QUERIES["kpi_summary"]
QUERIES["kpi_summary_exact"] = _KPI_EXACT
