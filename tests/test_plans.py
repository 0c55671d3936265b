"""Plan shapes that keep the analytics cheap at scale."""

import re

import pytest

from strata.operators.checks import profile
from strata.plans import analytics, quality
from strata.plans.warehouse import warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def w(spark):
    """The run, with shuffle joins as on large dimensions."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    run = warehouse(spark, SF)
    run.gold("fact_sales")
    run.rfm_raw()
    run.kpi_summary()
    run.product_sales()
    old = spark.conf.get(keys[0])
    for k in keys:
        spark.conf.set(k, "-1")
    yield run
    spark.conf.set(keys[0], old)
    spark.conf.unset(keys[1])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rfm_needs_no_sort_aggregate_and_no_join_back(w):
    text = plan(analytics.rfm_scores(w.rfm_raw()))
    assert "SortAggregate" not in text and "Join" not in text and "Exchange" not in text


def test_rfm_final_sort_is_on_more_than_the_total(w):
    text = plan(w.rfm_segmentation())
    assert re.search(r"rangepartitioning\(rfm_total#\d+L DESC NULLS LAST, customer_id", text)


def fact_side_exchanges(df):
    """Exchanges whose input is the stored fact itself, rows not yet reduced."""
    text = plan(df)
    found = []
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if " Exchange " in line or line.lstrip(" +-:").startswith("Exchange"):
            below = "\n".join(lines[i + 1:])
            first = re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|FileScan parquet[^\n]*", below)
            if first and first.group().startswith("FileScan") and re.search(
                    "fact_sales|sales_by_product", first.group()):
                found.append(line)
    return found


def test_rfm_and_product_plans_do_not_shuffle_the_fact(w):
    """With broadcast off: from the fact's scan to the first row per key there
    is no exchange; what is shuffled has one row per key and salt."""
    for df, key in ((analytics.rfm_raw(w.sales(), w.customers_keyed(), w.as_of), "customer_key"),
                    (analytics.product_sales(w.sales_by_product(), w.products_keyed()), "product_key")):
        text = plan(df)
        assert fact_side_exchanges(df) == []
        below = text[text.rindex("Exchange hashpartitioning"):]        # the lowest exchange
        assert "Join" in below and below.count("FileScan parquet") == 3   # the fact; flags, attributes
        assert re.search(rf"HashAggregate\(keys=\[{key}#\d+L, [cp]_salt#\d+", below)


def test_no_expand_in_any_distinct_count(w):
    for df in (w.monthly_revenue(), analytics.kpi_totals(w.sales(), w.customers_keyed()),
               analytics.customer_bitmaps(w.sales()), analytics.distinct_customers(w.customer_bitmaps()),
               analytics.product_sales(w.sales_by_product(), w.products_keyed()),
               analytics.rfm_raw(w.sales(), w.customers_keyed(), w.as_of)):
        assert "Expand" not in plan(df)
        assert fact_side_exchanges(df) == []


def test_kpi_reads_written_sums(w):
    """The fact is read for the totals alone; the tops come from one row per
    month, product and country, the customers from bitmaps."""
    text = plan(w.kpi_summary())
    assert "Expand" not in text
    assert len(re.findall(r"FileScan parquet[^\n]*fact_sales", text)) == 1


def test_marginals_are_summed_before_they_move(w):
    df = analytics.sales_marginals(w.sales(), w.gold("dim_products"), w.customers_keyed())
    assert fact_side_exchanges(df) == []      # the fact meets its customers where it lies
    lines = plan(df).splitlines()
    at = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert "partial_sum(sales_amount" in lines[at - 1] and "Exchange" in lines[at - 2]


def test_orphans_send_only_keys_through_the_fact_joins(w):
    text = plan(quality.check_orphans(w))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sum("customer_id" in s for s in scans) == 1      # attributes: for the survivors only
    assert any(re.fullmatch(r"customer_key#\d+L", s) for s in scans), scans


def test_profile_scans(w):
    text = plan(profile(w.bronze("crm_cust_info"), "t"))
    # the grouped pass; then rows that share a hash, and the hashes that are shared
    assert len(re.findall(r"FileScan parquet", text)) <= 3
