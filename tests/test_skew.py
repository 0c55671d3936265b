"""Heavy keys: the sketch finds them, salts split them, results stay the same."""

import pytest
from pyspark.sql import functions as F

from strata.operators import skew
from strata.operators.checks import lookup
from strata.plans import analytics, gold
from strata.sources.store import LayerStore

PARTS = 8


@pytest.fixture()
def shuffled(spark):
    """As on large dimensions: no broadcast; Spark's own skew handling is off."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sales(spark, n=60000):
    """A third of the rows on one customer, a third on one product, a tenth without customer."""
    r = F.xxhash64("id")
    cust = F.when(F.pmod(r, F.lit(3)) == 0, 7).when(F.pmod(r, F.lit(30)) == 1, None).otherwise(F.pmod(r, F.lit(2000)))
    prod = F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0, "hot").otherwise(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(900)).cast("string")))
    return spark.range(n).select(
        F.concat(F.lit("SO"), (F.col("id") / 3).cast("long").cast("string")).alias("sls_ord_num"),
        prod.alias("sls_prd_key"), cust.cast("long").alias("sls_cust_id"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 700).cast("int")).alias("sls_order_dt"),
        F.lit(None).cast("date").alias("sls_ship_dt"), F.lit(None).cast("date").alias("sls_due_dt"),
        (F.col("id") % 100).alias("sls_sales"), (F.col("id") % 5).alias("sls_quantity"),
        (F.col("id") % 11).alias("sls_price"))


def dims(spark):
    dc = spark.range(2000).select(
        (F.col("id") + 1).alias("customer_key"), F.col("id").alias("customer_id"),
        F.concat(F.lit("f"), F.col("id")).alias("first_name"), F.lit("l").alias("last_name"), F.lit("X").alias("country"))
    dc = dc.unionAll(dc.filter("customer_id % 40 = 7").withColumn("customer_key", F.col("customer_key") + 5000))
    dp = spark.range(900).select(
        (F.col("id") + 1).alias("product_key"), F.concat(F.lit("p"), F.col("id")).alias("product_number"),
        (F.col("id") % 600).cast("string").alias("product_name"), F.lit("c").alias("category"),
        F.lit("s").alias("subcategory"), F.lit("l").alias("product_line"), F.lit(3).alias("cost"))
    hot = dp.limit(1).select(F.lit(9999).cast("long").alias("product_key"), F.lit("hot").alias("product_number"),
                             F.lit("hot").alias("product_name"), "category", "subcategory", "product_line", "cost")
    return dc, dp.unionAll(hot)


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_sketch_finds_every_heavy_key(spark):
    heavy = skew.heavy_keys(sales(spark), ["sls_cust_id", "sls_prd_key", "sls_sales"], PARTS)
    found = {r["sls_cust_id"]: r["splits"] for r in heavy["sls_cust_id"].collect()}
    assert found[7] >= PARTS and all(s == 1 or k == 7 for k, s in found.items())
    assert {r["sls_prd_key"] for r in heavy["sls_prd_key"].collect() if r["splits"] > 2} == {"hot"}
    assert heavy["sls_sales"] is None            # a hundred values, none of them heavy
    assert skew.heavy_keys(sales(spark).filter("false"), ["sls_cust_id"], PARTS)["sls_cust_id"] is None
    nulls = spark.range(100).select(F.lit(None).cast("long").alias("k"))
    assert skew.heavy_keys(nulls, ["k"], PARTS)["k"] is None


def test_lookup_splits_the_hot_customer(shuffled):
    spark = shuffled
    sd, (dc, _) = sales(spark), dims(spark)
    heavy = skew.heavy_keys(sd, ["sls_cust_id"], PARTS)["sls_cust_id"]
    dim = dc.select(F.col("customer_id").alias("sls_cust_id"), "customer_key")
    plain, split = lookup(sd, dim, "sls_cust_id", "c_"), lookup(sd, dim, "sls_cust_id", "c_", heavy)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    n = sizes(split)
    assert len(n) == PARTS and n[-1] < 2 * n[PARTS // 2], n     # the largest task below twice the median
    assert sizes(plain)[-1] > 2 * sizes(plain)[PARTS // 2]      # what it would have been


def test_hot_keys_are_split_in_the_stored_fact_and_results_agree(shuffled, tmpdir_path):
    spark = shuffled
    store = LayerStore(spark, root=tmpdir_path)
    sd = store.write(sales(spark), "silver", "sales")
    dc, dp = dims(spark)
    heavy = skew.heavy_keys(sd, ["sls_cust_id", "sls_prd_key"])
    plain = gold.fact_sales(sd, dp, dc)
    fact = store.write(gold.fact_sales(sd, dp, dc, heavy), "gold", "fact", buckets=("customer_key", "c_salt"))
    lines = store.write(gold.sales_by_product(fact), "gold", "lines", buckets=("product_key", "p_salt"))
    assert fact.select(plain.columns).exceptAll(plain).count() == 0 and fact.count() == plain.count()
    ck = store.write(gold.customers_keyed(dc, heavy["sls_cust_id"]), "work", "ck", buckets=("customer_key", "c_salt"))
    pk = store.write(gold.products_keyed(dp, heavy["sls_prd_key"]), "work", "pk", buckets=("product_key", "p_salt"))
    for table, by in ((fact, ["customer_key", "c_salt"]), (lines, ["product_key", "p_salt"])):
        own = table.groupBy(*by).count().withColumn("p", F.spark_partition_id())
        per = sorted(r["n"] for r in own.groupBy("p").agg(F.sum("count").alias("n")).collect())
        assert len(per) == PARTS and per[-1] < 2 * per[PARTS // 2], per
    cases = [(analytics.rfm_raw(fact, ck, "2026-01-01"), analytics.rfm_raw(plain, dc, "2026-01-01")),
             (analytics.product_sales(lines, pk), analytics.product_sales(plain, dp)),
             (analytics.monthly_revenue(fact), analytics.monthly_revenue(plain)),
             (analytics.kpi_summary(fact, dp, ck), analytics.kpi_summary(plain, dp, dc))]
    for got, want in cases:
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0


def test_results_equal_plain_distinct_counts(spark):
    """Keys that share a reporting group hold the same orders: counted once."""
    sd, (dc, dp) = sales(spark, 6000), dims(spark)
    fact = gold.fact_sales(sd, dp, dc)
    dated = fact.filter("order_date is not null")
    group = ["customer_id", "first_name", "last_name", "country"]
    want = (dated.join(dc, "customer_key").groupBy(*group).agg(
        F.max("order_date").alias("last_order_date"), F.countDistinct("order_number").alias("frequency"),
        F.sum("sales_amount").alias("monetary")))
    got = analytics.rfm_raw(fact, dc, "2026-01-01").select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    per = ["product_name", "category", "subcategory", "product_line", F.col("cost").alias("unit_cost")]
    want = dated.join(dp, "product_key").groupBy(*per).agg(
        F.sum("sales_amount").alias("total_revenue"), F.sum("quantity").alias("units_sold"),
        F.countDistinct("order_number").alias("order_count"))
    got = analytics.product_sales(fact, dp).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    want = dated.groupBy(F.trunc("order_date", "MM").alias("month_start")).agg(
        F.sum("sales_amount").alias("revenue"), F.countDistinct("order_number").alias("order_count"),
        F.countDistinct("customer_key").alias("unique_customers"))
    got = analytics.monthly_revenue(fact)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_bitmaps_merge_over_months(spark):
    sd, (dc, dp) = sales(spark, 6000), dims(spark)
    fact = gold.fact_sales(sd, dp, dc)
    bitmaps = analytics.customer_bitmaps(fact)
    year = analytics.distinct_customers(bitmaps, F.trunc("month_start", "YEAR").alias("y"))
    want = fact.groupBy(F.trunc("order_date", "YEAR").alias("y")).agg(F.countDistinct("customer_key").alias("n"))
    assert sorted(tuple(r) for r in year.collect()) == sorted(tuple(r) for r in want.collect())
    assert analytics.distinct_customers(bitmaps).first()[0] == fact.select("customer_key").distinct().filter(
        "customer_key is not null").count()
    assert analytics.distinct_customers(bitmaps.filter("false")).first()[0] == 0
