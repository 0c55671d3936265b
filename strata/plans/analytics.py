"""Business questions on the star schema: RFM, monthly trend, KPIs, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.cleanse import int_div, round_ratio
from strata.operators.ranking import global_rank, multi_ntile
from strata.plans import gold


def _asc(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


# ---------------------------------------------------------------- layout
def _salted(sales: DataFrame, salt: str) -> DataFrame:
    """The fact of a run carries the salts of its heavy keys; any other frame
    has none."""
    return sales if salt in sales.columns else sales.withColumn(salt, F.lit(0))


def _customers(dc: DataFrame) -> DataFrame:
    return dc if "c_salt" in dc.columns else gold.customers_keyed(dc)


def _products(dp: DataFrame) -> DataFrame:
    return dp if "p_salt" in dp.columns else gold.products_keyed(dp)


def _known(dc: DataFrame, *cols: str) -> DataFrame:
    """The customers' join keys, with ``cols``."""
    return _salted(dc, "c_salt").select("customer_key", "c_salt", *cols)


def _per_group(orders: DataFrame, dim: DataFrame, key: str, salt: str, group: tuple[str, ...],
               aggs: dict[str, Column]) -> DataFrame:
    """Aggregates and distinct orders (``orders``) of each reporting group.

    ``orders`` has one row per (key, salt, order_number) and partial values;
    ``aggs`` merges a value with itself.  Where the frames are bucketed by (key,
    salt), nothing is shuffled until a key without a shared group is one row
    per salt.  Only groups that several keys share keep their orders to the
    end, as these keys may hold the same order; they travel under the group's
    smallest key, and the group itself as one more row of that key.
    """
    on = [key, salt]
    known = orders.join(dim.select(*on, "shared", "group_key"), on)
    shared = F.when(F.col("shared"), F.col("order_number")).alias("_order")
    own = F.count_if(~F.col("shared") & F.col("order_number").isNotNull()).alias("_own")
    merge = [c.alias(n) for n, c in aggs.items()]
    local = known.groupBy(*on, "group_key", shared).agg(*merge, own)
    named = dim.filter((F.col(key) == F.col("group_key")) & (F.col(salt) == 0)).select(
        "group_key", F.struct(*group).alias("_group"))
    merged = local.groupBy("group_key", "_order").agg(*merge, F.sum("_own").alias("_own"))
    whole = merged.groupBy("group_key").agg(*merge, (F.sum("_own") + F.count("_order")).alias("orders"))
    # one row of results and one of names for each group that has sales
    rows = whole.unionByName(named, allowMissingColumns=True)
    return (rows.groupBy("group_key").agg(*[F.max(c).alias(c) for c in (*aggs, "orders", "_group")])
            .filter("orders is not null").select("_group.*", *aggs, "orders"))


def _dated_orders(sales: DataFrame, key: str, salt: str, *aggs: Column) -> DataFrame:
    """Dated sales reduced to one row per (key, salt, order); without a
    shuffle where they are bucketed by (key, salt)."""
    return (_salted(sales, salt).filter(F.col("order_date").isNotNull())
            .groupBy(key, salt, "order_number").agg(*aggs))


# ---------------------------------------------------------------- RFM
def rfm_raw(fact: DataFrame, dc: DataFrame, as_of: str) -> DataFrame:
    """Per customer: last order, days since, distinct orders, total sales.

    Several keys can share one customer group (ERP fan-out), so orders are
    counted distinct within a group.
    """
    orders = _dated_orders(fact, "customer_key", "c_salt", F.max("order_date").alias("_last"),
                           F.sum("sales_amount").alias("_sales"))
    g = _per_group(orders, _customers(dc), "customer_key", "c_salt", gold.CUSTOMER_GROUP,
                   {"_last": F.max("_last"), "_sales": F.sum("_sales")})
    return g.select(
        "customer_id", "first_name", "last_name",
        # '+' on strings: NULL when either part is NULL, hence concat (not concat_ws)
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "country", F.col("_last").alias("last_order_date"),
        F.datediff(F.lit(as_of).cast("date"), F.col("_last")).cast("long").alias("recency_days"),
        F.col("orders").alias("frequency"), F.col("_sales").alias("monetary"))


# Ties inside one NTILE order are broken by the group key of rfm_raw.
RFM_TIEBREAK = ("customer_id", "country", "first_name", "last_name")


def rfm_scores(raw: DataFrame, best_high: bool = False) -> DataFrame:
    """NTILE(5) on recency, frequency and monetary over all customers.

    Literal order: tile 1 = most recent / most frequent / highest spend.
    ``best_high`` reverses the three orders so that 5 is best.  Ties are
    broken by the group key of rfm_raw; nothing is sorted (``multi_ntile``).
    """
    if best_high:
        keys = {"r_score": ("recency_days", False), "f_score": ("frequency", True),
                "m_score": ("monetary", True)}
    else:
        keys = {"r_score": ("recency_days", True), "f_score": ("frequency", False),
                "m_score": ("monetary", False)}
    return multi_ntile(raw, 5, keys, list(RFM_TIEBREAK))


def rfm_segments(scored: DataFrame) -> DataFrame:
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    segment = (F.when(F.col("rfm_total") >= 13, "Champions")
               .when(F.col("rfm_total") >= 10, "Loyal")
               .when((F.col("r_score") <= 2) & (F.col("f_score") >= 3), "At Risk")
               .when(F.col("rfm_total") <= 6, "Lost")
               .otherwise("Potential"))
    return (scored.withColumn("rfm_total", total)
            .select("customer_id", "customer_name", "country", "last_order_date",
                    "recency_days", "frequency", F.col("monetary").alias("lifetime_value"),
                    "r_score", "f_score", "m_score", "rfm_total",
                    segment.alias("segment"))
            # the key behind the total keeps the 13 totals from being 13 tasks
            .orderBy(F.col("rfm_total").desc_nulls_last(), *_asc("customer_id", "customer_name",
                                                                 "country")))


# ---------------------------------------------------------------- trend
def customer_bitmaps(fact: DataFrame) -> DataFrame:
    """The customers of each month as exact bitmaps over the dense surrogate
    keys: (month_start, bucket, bitmap), 32,768 customers a bucket.

    Customers are first reduced to one row per month where the fact is bucketed
    by customer (no shuffle), then each bucket is built in one place.  Bitmaps
    of several months merge by OR, so any longer period's distinct customers
    come from this table alone.
    """
    months = (_salted(fact, "c_salt").filter(F.col("order_date").isNotNull() & F.col("customer_key").isNotNull())
              .select("customer_key", "c_salt", F.trunc("order_date", "MM").alias("month_start")).distinct())
    bits = months.select("month_start", F.bitmap_bucket_number("customer_key").alias("bucket"),
                         F.bitmap_bit_position("customer_key").alias("bit"))
    return (bits.repartition("month_start", "bucket").groupBy("month_start", "bucket")
            .agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def distinct_customers(bitmaps: DataFrame, *period: Column) -> DataFrame:
    """Distinct customers (``unique_customers``) of each ``period`` of months."""
    names = [f"period_{i}" for i in range(len(period))]
    merged = bitmaps.groupBy(*[p.alias(n) for p, n in zip(period, names)], "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*names).agg(
        F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("unique_customers"))


def monthly_revenue(fact: DataFrame, bitmaps: DataFrame | None = None) -> DataFrame:
    """Per month: revenue, distinct orders, distinct customers.

    Lines are summed per (customer, order, month) where they lie, then per
    (month, order), whose rows are the orders.  A month's bitmaps hold each of
    its customers once; their counts are added up beside the orders.
    """
    lines = (_salted(fact, "c_salt").filter(F.col("order_date").isNotNull())
             .groupBy("customer_key", "c_salt", "order_number", F.trunc("order_date", "MM").alias("month_start"))
             .agg(F.sum("sales_amount").alias("sales")))
    orders = lines.groupBy("month_start", "order_number").agg(F.sum("sales").alias("sales")).select(
        "month_start", "sales", F.col("order_number").isNotNull().cast("long").alias("orders"),
        F.lit(0).cast("long").alias("customers"))
    bitmaps = customer_bitmaps(fact) if bitmaps is None else bitmaps
    counts = bitmaps.select("month_start", F.lit(None).cast("long").alias("sales"),
                            F.lit(0).cast("long").alias("orders"), F.bitmap_count("bitmap").alias("customers"))
    return orders.unionAll(counts).groupBy("month_start").agg(
        F.sum("sales").alias("revenue"), F.sum("orders").alias("order_count"),
        F.sum("customers").alias("unique_customers"))


def revenue_trends(monthly: DataFrame, exact: bool = False) -> DataFrame:
    """Month-over-month growth and 3-month rolling average.

    The input has one row per month (bounded by the calendar), so the
    unpartitioned windows here run over a handful of rows.  Months without
    sales are not filled in: LAG and the frame count rows.  ``exact`` keeps
    the decimals of the rolling average (rounded to 2) instead of truncating.
    """
    w = Window.orderBy("month_start")
    frame = w.rowsBetween(-2, 0)
    prev = F.lag("revenue").over(w)
    return (monthly.select(
        "month_start",
        month_label(F.col("month_start")).alias("month_label"),
        "revenue", "order_count", "unique_customers",
        round_ratio(F.col("revenue") - prev, prev, 2).alias("mom_growth_pct"),
        # AVG of an integer column is an integer (truncated) in the source engine
        (round_ratio(F.sum("revenue").over(frame), F.count("revenue").over(frame), 2, scale=1)
         if exact else
         int_div(F.sum("revenue").over(frame), F.count("revenue").over(frame)))
        .alias("rolling_3m_avg"))
        .orderBy("month_start"))


# ---------------------------------------------------------------- KPI row
_SETS = ("month_start", "product_key", "country")
_KINDS = {3: "month", 5: "product", 6: "country"}  # grouping_id() of each set
_TOPS = {"best_sales_month": "month", "top_product": "product", "top_country": "country"}


def sales_marginals(fact: DataFrame, dp: DataFrame, dc: DataFrame) -> DataFrame:
    """Summed sales (rev) of each month, product name and country, as rows of
    (kind, month_start, label), over dated sales of a known customer and product.

    The fact meets its customers where it lies; GROUPING SETS keeps the three
    sums in each task, and only these are shuffled.  The product is known if its
    key is not NULL, as the fact's keys are looked up in the dimension.
    """
    lines = (_salted(fact, "c_salt").filter(F.col("order_date").isNotNull() & F.col("product_key").isNotNull())
             .join(_known(dc, "country"), ["customer_key", "c_salt"])
             .select(F.trunc("order_date", "MM").alias("month_start"), "product_key", "country", "sales_amount"))
    sums = lines.groupingSets([[c] for c in _SETS], *_SETS).agg(
        F.sum("sales_amount").alias("rev"), F.grouping_id().alias("_gid"))
    names = dp.select(F.col("product_key").alias("_pk"), "product_name")
    by_gid = lambda f: F.coalesce(*[F.when(F.col("_gid") == g, f(k)) for g, k in _KINDS.items()])
    named = sums.join(names, F.col("product_key") == F.col("_pk"), "left").select(
        by_gid(F.lit).alias("kind"), "month_start",
        F.when(F.col("_gid") == 5, F.col("product_name")).when(F.col("_gid") == 6, F.col("country"))
        .alias("label"), "rev")
    return named.groupBy("kind", "month_start", "label").agg(F.sum("rev").alias("rev"))


def _labelled(marginals: DataFrame) -> DataFrame:
    label = F.when(F.col("kind") == "month", month_label(F.col("month_start"))).otherwise(F.col("label"))
    return marginals.select("kind", label.alias("label"), "rev")


def top_labels(marginals: DataFrame) -> DataFrame:
    """TOP 1 month, product and country by summed sales.

    The best row of each kind is a row_number = 1 filter, planned as a partial
    WindowGroupLimit before its shuffle.  Ties go to the smallest label.  One
    row with three columns (NULL when empty).
    """
    w = Window.partitionBy("kind").orderBy(F.col("rev").desc_nulls_last(), F.col("label").asc_nulls_first())
    best = _labelled(marginals).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return best.agg(*[F.max(F.when(F.col("kind") == kind, F.col("label"))).alias(name)
                      for name, kind in _TOPS.items()])


def top_of(marginals: DataFrame, kind: str, name: str) -> DataFrame:
    """TOP 1 ``name`` by summed sales with its revenue (ties: smallest label):
    a per-task top-1 (TakeOrderedAndProject), never a global sort."""
    rows = _labelled(marginals.filter(F.col("kind") == kind)).select(F.col("label").alias(name), "rev")
    return rows.orderBy(F.col("rev").desc_nulls_last(), F.col(name).asc_nulls_first()).limit(1)


def month_label(month_start: Column) -> Column:
    """'Jan 2001' for a month.  Format after aggregating by ``trunc(d, 'MM')``:
    one label per month instead of one formatter call per sales row."""
    return F.date_format(month_start, "MMM yyyy")


def kpi_totals(fact: DataFrame, dc: DataFrame) -> DataFrame:
    """Revenue, units and distinct orders of sales with a known customer: one
    row.  Orders are complete before their distinct count shuffles them."""
    orders = _dated_orders(fact, "customer_key", "c_salt", F.sum("sales_amount").alias("_sales"),
                           F.sum("quantity").alias("_units"))
    known = orders.join(_known(dc), ["customer_key", "c_salt"])
    one = known.groupBy("order_number").agg(F.sum("_sales").alias("_sales"), F.sum("_units").alias("_units"))
    return one.agg(F.sum("_sales").alias("sales"), F.sum("_units").alias("units"),
                   F.count("order_number").alias("orders"))


def kpi_summary(fact: DataFrame, dp: DataFrame, dc: DataFrame, exact: bool = False,
                marginals: DataFrame | None = None, bitmaps: DataFrame | None = None) -> DataFrame:
    """The KPI row; ``exact`` keeps the decimals of the average order value.
    ``marginals`` and ``bitmaps`` are written ``sales_marginals`` and
    ``customer_bitmaps`` of the same tables, if there are any."""
    if bitmaps is None:
        bitmaps = customer_bitmaps(_salted(fact, "c_salt").join(_known(dc), ["customer_key", "c_salt"]))
    marginals = sales_marginals(fact, dp, dc) if marginals is None else marginals
    s, o = F.col("sales"), F.col("orders")
    # Scalar subqueries carry the one-row frames; empty input gives NULLs.
    tops = top_labels(marginals).select(F.struct(*_TOPS).alias("_t")).scalar()
    totals = kpi_totals(fact, dc).select(
        s.alias("total_revenue"),
        (round_ratio(s, o, 2, scale=1) if exact else int_div(s, o)).alias("avg_order_value"),
        o.alias("total_orders"), distinct_customers(bitmaps).scalar().alias("unique_customers"),
        round_ratio(F.col("units"), o, 1, scale=1).alias("avg_items_per_order"), tops.alias("_t"))
    return totals.select(*totals.columns[:-1], *[F.col(f"_t.{n}").alias(n) for n in _TOPS])


# ---------------------------------------------------------------- products
def product_sales(fact: DataFrame, dp: DataFrame, exact: bool = False) -> DataFrame:
    """Per product group: revenue, units, distinct orders, average price.

    The source engine averages an integer column to an integer (truncated);
    ``exact`` keeps two decimals instead.
    """
    orders = _dated_orders(fact, "product_key", "p_salt", F.sum("sales_amount").alias("_sales"),
                           F.sum("quantity").alias("_units"), F.sum("price").alias("_price"),
                           F.count("price").alias("_prices"))
    g = _per_group(orders, _products(dp), "product_key", "p_salt", gold.PRODUCT_GROUP,
                   {c: F.sum(c) for c in ("_sales", "_units", "_price", "_prices")})
    price, n = F.col("_price"), F.col("_prices")
    return g.select(
        *gold.PRODUCT_GROUP[:-1], F.col("cost").alias("unit_cost"), F.col("_sales").alias("total_revenue"),
        F.col("_units").alias("units_sold"), F.col("orders").alias("order_count"),
        (round_ratio(price, n, 2, scale=1) if exact else int_div(price, n)).alias("avg_selling_price"))


def product_ranked(ps: DataFrame, exact: bool = False) -> DataFrame:
    """Share of total, revenue rank (RANK semantics) and estimated margin.

    With ``exact`` the average price has two decimals; the margin is then
    computed in cents so it stays exact.
    """
    total = ps.agg(F.sum("total_revenue")).scalar()
    ranked = global_rank(ps, ["total_revenue"], [False],
                         _asc("product_name", "category", "subcategory", "product_line",
                              "unit_cost"), "revenue_rank")
    return ranked.select(
        "*",
        round_ratio(F.col("total_revenue"), total, 2).alias("pct_of_total"),
        (round_ratio(F.round(F.col("avg_selling_price") * 100) - F.col("unit_cost") * 100,
                     F.round(F.col("avg_selling_price") * 100), 1) if exact else
         round_ratio(F.col("avg_selling_price") - F.col("unit_cost"),
                     F.col("avg_selling_price"), 1)).alias("est_margin_pct"))


def top_bottom(ranked: DataFrame, n: int = 10) -> DataFrame:
    """Top n by rank (ties may exceed n) and bottom n with revenue > 0."""
    count = ranked.agg(F.count(F.lit(1))).scalar()
    top = ranked.filter(F.col("revenue_rank") <= n).withColumn("tier", F.lit(f"Top {n}"))
    bottom = (ranked.filter((F.col("revenue_rank") > count - n) & (F.col("total_revenue") > 0))
              .withColumn("tier", F.lit(f"Bottom {n}")))
    cols = ["tier", "product_name", "category", "subcategory", "product_line",
            "total_revenue", "units_sold", "order_count", "avg_selling_price", "unit_cost",
            "pct_of_total", "revenue_rank", "est_margin_pct"]
    return (top.select(cols).unionAll(bottom.select(cols))
            .orderBy(F.col("tier").desc(), F.col("revenue_rank").asc()))
