"""Unit frames for silver, gold, analytics and checks (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.checks import check_fk, check_unique, profile
from strata.plans import analytics, gold, silver

CUST = ("cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date")
D = dt.date


def test_dedup_latest_and_tie(spark):
    b = spark.createDataFrame([
        (1, "AW2", "a", "b", "S", "F", D(2025, 1, 1)),
        (1, "AW1", "a", "b", "M", "M", D(2025, 1, 1)),   # same date: smallest key wins
        (2, "AW3", " x ", "y", "m", "f", D(2024, 1, 1)),
        (2, "AW3", "old", "y", "S", "F", D(2023, 1, 1)),
        (None, "AW9", "n", "n", "S", "F", D(2026, 1, 1)),  # NULL id dropped
    ], CUST)
    out = {r.cst_id: r for r in silver.crm_cust_info(b).collect()}
    assert set(out) == {1, 2}
    assert out[1].cst_key == "AW1" and out[1].cst_marital_status == "Married"
    assert out[2].cst_firstname == "x" and out[2].cst_gndr == "Female"


def test_product_versions(spark):
    b = spark.createDataFrame([
        (10, "CO-RF-FR-R92B", "n", None, "m ", dt.datetime(2011, 1, 1), None),
        (11, "CO-RF-FR-R92B", "n", 5, "r", dt.datetime(2012, 1, 1), None),
        (12, "CO-RF-FR-R92B", "n", 6, "x", dt.datetime(2012, 1, 1), None),  # equal start
        (20, "AC-HE-HL-U509", "m", 3, None, dt.datetime(2013, 7, 1), None),
    ], "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
       "prd_start_dt timestamp, prd_end_dt timestamp")
    out = {r.prd_id: r for r in silver.crm_prd_info(b).collect()}
    assert out[10].cat_id == "CO_RF" and out[10].prd_key == "FR-R92B"
    assert out[10].prd_cost == 0 and out[10].prd_line == "Mountain"
    assert out[10].prd_end_dt == D(2011, 12, 31)
    assert out[11].prd_end_dt == D(2011, 12, 31)   # next version starts the same day
    assert out[12].prd_end_dt is None and out[20].prd_end_dt is None


def _silver_for_dims(spark):
    ci = spark.createDataFrame([
        (1, "AW1", "A", "One", "Single", "n/a", D(2025, 1, 1)),
        (2, "AW2", "B", None, "Married", "Male", D(2025, 1, 2)),
    ], CUST)
    ca = spark.createDataFrame([("AW1", D(1980, 1, 1), "Female"), ("AW1", D(1981, 1, 1), "Male")],
                               "cid string, bdate date, gen string")
    la = spark.createDataFrame([("AW1", "Germany"), ("AW2", "France")], "cid string, cntry string")
    return ci, ca, la


def test_dim_customers_fanout_and_gender(spark):
    dc = gold.dim_customers(*_silver_for_dims(spark))
    rows = dc.orderBy("customer_key").collect()
    assert [r.customer_key for r in rows] == [1, 2, 3]
    assert [r.customer_id for r in rows] == [1, 1, 2]          # ERP fan-out: two keys
    assert [r.gender for r in rows] == ["Female", "Male", "Male"]
    assert check_unique(dc, "customer_id").count() == 1      # business key check fires
    assert check_unique(dc, "customer_key").count() == 0


def test_duplicate_ids_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "cst_id int")
    got = {r.cst_id: r.row_count for r in
           check_unique(df, "cst_id", null_is_violation=True).collect()}
    assert got == {1: 2, None: 1}


def _fact(spark, rows):
    return spark.createDataFrame(rows, "order_number string, product_key long, customer_key long, "
                                 "order_date date, shipping_date date, due_date date, "
                                 "sales_amount int, quantity int, price int")


def test_first_month_only(spark):
    f = _fact(spark, [("SO1", 1, 1, D(2020, 3, 5), None, None, 100, 1, 100),
                      ("SO2", 1, 1, D(2020, 3, 9), None, None, 50, 1, 50)])
    r = analytics.revenue_trends(analytics.monthly_revenue(f)).collect()
    assert len(r) == 1
    assert r[0].mom_growth_pct is None and r[0].rolling_3m_avg == 150
    assert r[0].month_label == "Mar 2020" and r[0].order_count == 2


def test_trend_growth_and_rolling(spark):
    f = _fact(spark, [("SO1", 1, 1, D(2020, 1, 5), None, None, 100, 1, 100),
                      ("SO2", 1, 1, D(2020, 2, 9), None, None, 151, 1, 151),
                      ("SO3", 1, 2, D(2020, 3, 9), None, None, 50, 1, 50)])
    r = analytics.revenue_trends(analytics.monthly_revenue(f)).collect()
    assert [x.mom_growth_pct for x in r] == [None, 51.0, -66.89]
    assert [x.rolling_3m_avg for x in r] == [100, 125, 100]   # integer average


def test_kpi_empty_input(spark):
    f = _fact(spark, [])
    dp = spark.createDataFrame([], "product_key long, product_name string")
    dc = spark.createDataFrame([], "customer_key long, country string")
    r = analytics.kpi_summary(f, dp, dc).collect()
    assert len(r) == 1
    r = r[0]
    assert r.total_revenue is None and r.total_orders == 0 and r.unique_customers == 0
    assert r.best_sales_month is None and r.top_product is None and r.top_country is None


def test_rank_ties_top_tier(spark):
    # 12 products; the last three tie at rank 10, so the top tier holds all 12
    rows = [(f"p{i}", "c", "s", "l", 100 - i if i < 9 else 50, 1, 1, 10, 5) for i in range(12)]
    ps = spark.createDataFrame(rows, "product_name string, category string, subcategory string, "
                               "product_line string, total_revenue long, units_sold long, "
                               "order_count long, avg_selling_price long, unit_cost int")
    out = analytics.top_bottom(analytics.product_ranked(ps)).collect()
    top = [r for r in out if r.tier == "Top 10"]
    assert len(top) == 12
    assert sorted(r.revenue_rank for r in top)[-3:] == [10, 10, 10]


def test_orphans_and_profile(spark):
    f = _fact(spark, [("SO1", 1, 1, D(2020, 1, 1), None, None, 1, 1, 1),
                      ("SO2", None, 1, D(2020, 1, 1), None, None, 1, 1, 1),
                      ("SO3", 1, 9, D(2020, 1, 1), None, None, 1, 1, 1)])
    dc = spark.createDataFrame([(1, "x")], "customer_key long, country string")
    dp = spark.createDataFrame([(1, "p")], "product_key long, product_name string")
    o = check_fk(f, [(dc, "customer_key", "c_"), (dp, "product_key", "p_")])
    assert sorted(r.order_number for r in o.collect()) == ["SO2", "SO3"]
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    p = profile(df, "t").first()
    assert (p.row_count, p.null_cells, p.duplicates) == (3, 2, 1)
    assert abs(p.null_pct - 100 * 2 / 6) < 1e-12


def test_publish_catalog(spark):
    from strata.plans.warehouse import warehouse
    w = warehouse(spark, "/root/testdata/sf0.001")
    names = w.publish_catalog()
    assert "gold.fact_sales" in names and "bronze.crm_cust_info" in names
    n = spark.sql("SELECT count(*) FROM gold.fact_sales").first()[0]
    assert n == w.gold("fact_sales").count()
    assert spark.sql("SELECT count(*) FROM bronze.crm_cust_info").first()[0] == \
        w.bronze("crm_cust_info").count()


def test_exact_variants_keep_decimals(spark):
    f = _fact(spark, [("SO1", 1, 1, D(2020, 1, 5), None, None, 100, 1, 3),
                      ("SO2", 1, 1, D(2020, 2, 9), None, None, 151, 1, 4),
                      ("SO3", 1, 2, D(2020, 3, 9), None, None, 50, 1, 4)])
    r = analytics.revenue_trends(analytics.monthly_revenue(f), exact=True).collect()
    assert [x.rolling_3m_avg for x in r] == [100.0, 125.5, 100.33]
    dp = spark.createDataFrame([(1, "p", "c", "s", "l", 2)], "product_key long, product_name string, "
                               "category string, subcategory string, product_line string, cost int")
    ps = analytics.product_sales(f, dp, exact=True).first()
    assert ps.avg_selling_price == 3.67
    lit = analytics.product_sales(f, dp).first()
    assert lit.avg_selling_price == 3                     # integer average, truncated
    ranked = analytics.product_ranked(analytics.product_sales(f, dp, exact=True), exact=True).first()
    assert ranked.est_margin_pct == 45.5                  # 100 * (3.67 - 2) / 3.67


def test_lookup_salt_stays_a_join_key(spark):
    """With broadcast off, NULL keys must spread: the salt is a shuffle key."""
    from strata.operators.checks import lookup
    fact = spark.range(2000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 7)
                                    .alias("k"), "id")
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(fact, dim, "k", "d_")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_lk_fsalt" in plan.split("SortMergeJoin")[1].split("\n")[0]
        rows = out.collect()
        assert len(rows) == 2000
        assert all((r.d_v is None) == (r.k is None) for r in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_rfm_segment_branches_first_match_wins(spark):
    rows = [  # (id, r, f, m) -> expected segment
        (1, 5, 5, 5, "Champions"),   # 15
        (2, 5, 4, 4, "Champions"),   # 13
        (3, 2, 4, 4, "Loyal"),       # 10, also r<=2 & f>=3: Loyal wins (earlier branch)
        (4, 2, 3, 2, "At Risk"),     # 7
        (5, 1, 3, 1, "At Risk"),     # 5: At Risk before Lost
        (6, 3, 2, 1, "Lost"),        # 6
        (7, 3, 2, 2, "Potential"),   # 7, r > 2
        (8, 1, 2, 4, "Potential"),   # 7, f < 3
    ]
    df = spark.createDataFrame(
        [(i, f"n{i}", "c", D(2020, 1, 1), 1, 1, 100, r, f, m) for i, r, f, m, _ in rows],
        "customer_id int, customer_name string, country string, last_order_date date, "
        "recency_days long, frequency long, monetary long, r_score long, f_score long, m_score long")
    got = {r.customer_id: r.segment for r in analytics.rfm_segments(df).collect()}
    assert got == {i: seg for i, _, _, _, seg in rows}


def test_empty_input_gives_empty_reports(spark):
    f = _fact(spark, [])
    dc = spark.createDataFrame([], "customer_key long, customer_id int, first_name string, "
                               "last_name string, country string")
    dp = spark.createDataFrame([], "product_key long, product_name string, category string, "
                               "subcategory string, product_line string, cost int")
    assert analytics.revenue_trends(analytics.monthly_revenue(f)).count() == 0
    raw = analytics.rfm_raw(f, dc, "2026-01-01")
    assert analytics.rfm_segments(analytics.rfm_scores(raw)).count() == 0
    ps = analytics.product_sales(f, dp)
    assert analytics.top_bottom(analytics.product_ranked(ps)).count() == 0


def test_concurrent_callers_build_each_layer_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    from strata.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    writes = []
    original = w.store.write

    def counting_write(df, layer, table, **how):
        writes.append((layer, table))
        return original(df, layer, table, **how)

    w.store.write = counting_write
    jobs = [lambda: w.revenue_trends().count(), lambda: w.kpi_summary().count(),
            lambda: w.rfm_segmentation().count(), lambda: w.product_performance().count(),
            lambda: w.gold("dim_customers").count(), lambda: w.silver("crm_prd_info").count()]
    with ThreadPoolExecutor(6) as pool:
        counts = [f.result() for f in [pool.submit(j) for j in jobs]]
    assert counts[0] == 80 and counts[1] == 1
    assert len(writes) == len(set(writes)), sorted(writes)


def test_retire_older_runs(spark, tmpdir_path):
    """Only published runs of the same owner go; the newest ones stay."""
    import os

    from strata.sources.store import LayerStore
    root = os.path.join(tmpdir_path, "ckpt")
    stores = [LayerStore(spark, root=root) for _ in range(4)]
    other = LayerStore(spark, root=root, owner="someone else")
    for st in [*stores, other]:
        st.write(spark.range(3), "silver", "t")
    runs = lambda: {r for r in os.listdir(os.path.join(root, "strata"))}
    assert len(runs()) == 5
    stores[-1].publish()
    assert stores[-1].retire_older_runs(keep=1) == [] and len(runs()) == 5  # none is published
    other.publish()
    stores[0].publish()
    stores[1].publish()
    assert len(stores[-1].retire_older_runs(keep=2)) == 1
    assert {f"run-{st.run_id}" for st in (stores[2], stores[3], other)} < runs() and len(runs()) == 4
    assert stores[-1].read("silver", "t").count() == 3


def test_reopened_run_loads_nothing_again(spark, tmpdir_path):
    import os
    import shutil

    import pytest

    from strata.plans.warehouse import Warehouse
    from strata.sources.store import LayerStore
    root = os.path.join(tmpdir_path, "ckpt")
    sf = os.path.join(tmpdir_path, "sf")
    shutil.copytree("/root/testdata/sf0.001", sf)
    os.chmod(sf, 0o755)
    first = Warehouse(spark, sf, store=LayerStore(spark, root=root))
    want = first.gold("fact_sales").count()
    again = Warehouse(spark, sf, store=LayerStore(spark, root=root, run_id=first.store.run_id))
    again.store.write = None  # any load would fail now
    assert again.gold("fact_sales").count() == want
    assert {r.table_name for r in again.load_silver().collect()} >= {"(all)", "crm_prd_info"}
    os.utime(os.path.join(sf, "part.parquet"), (1, 1))  # another input
    with pytest.raises(ValueError, match="another input"):
        Warehouse(spark, sf, store=LayerStore(spark, root=root, run_id=first.store.run_id))


def test_load_timestamp_and_batch_totals(spark):
    from strata.plans.warehouse import warehouse
    w = warehouse(spark, "/root/testdata/sf0.001")
    ts = w.silver("crm_cust_info", with_load_ts=True).select("dwh_create_date")
    low, high, rows, given = ts.agg(F.min("dwh_create_date"), F.max("dwh_create_date"), F.count("*"),
                                    F.count("dwh_create_date")).first()
    assert low == high and rows == given > 0 and abs((dt.datetime.now() - low).total_seconds()) < 7200
    for audit in (w.load_bronze(), w.load_silver()):
        by = {r.table_name: r for r in audit.collect()}
        assert by["(all)"].row_count == sum(r.row_count for t, r in by.items() if t != "(all)")
        assert by["(all)"].seconds > 0


def test_durable_publish_needs_a_persistent_catalog(spark):
    import pytest

    from strata.plans.warehouse import warehouse
    with pytest.raises(RuntimeError, match="in-memory"):
        warehouse(spark, "/root/testdata/sf0.001").publish_catalog(durable=True)


def test_store_drop_removes_own_run_only(spark, tmpdir_path):
    import os

    from strata.sources.store import LayerStore
    root = os.path.join(tmpdir_path, "ckpt")
    a, b = LayerStore(spark, root=root), LayerStore(spark, root=root)
    a.write(spark.range(2), "gold", "t")
    b.write(spark.range(2), "gold", "t")
    a.drop()
    assert os.listdir(os.path.join(root, "strata")) == [f"run-{b.run_id}"]


def test_profile_duplicates_exact_with_copies_and_collisions(spark):
    import random
    rnd = random.Random(3)
    rows = [("a", None), (None, "a"), ("a", None)]           # null positions hash alike
    rows += [("hot", "copy")] * 400                           # one group of copies, a third+
    rows += [(rnd.choice(["x", "y", None]), rnd.choice(["1", "2", "3", None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b string")
    expect = df.count() - df.distinct().count()
    assert profile(df, "t").first().duplicates == expect
