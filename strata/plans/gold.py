"""Gold layer: the star schema (two dimensions and the sales fact)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import skew
from strata.operators.checks import lookup
from strata.operators.ranking import surrogate_key


def dim_customers(ci: DataFrame, ca: DataFrame, la: DataFrame) -> DataFrame:
    """CRM customers + ERP birthdate/gender + ERP country, keyed by cst_id order."""
    ca = ca.select(F.col("cid").alias("cst_key"), "bdate", "gen")
    la = la.select(F.col("cid").alias("cst_key"), "cntry")
    j = lookup(lookup(ci, ca, "cst_key", "_ca_"), la, "cst_key", "_la_")
    j = j.select(*ci.columns, F.col("_ca_bdate").alias("bdate"), F.col("_ca_gen").alias("gen"),
                 F.col("_la_cntry").alias("cntry"))
    keyed = surrogate_key(j, [F.col(c).asc_nulls_first() for c in
                              ("cst_id", "cst_key", "bdate", "gen", "cntry")], "customer_key")
    gender = (F.when(F.col("cst_gndr") != "n/a", F.col("cst_gndr"))
              .otherwise(F.coalesce(F.col("gen"), F.lit("n/a"))))
    return keyed.select(
        "customer_key",
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        gender.alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"))


def dim_products(pn: DataFrame, pc: DataFrame) -> DataFrame:
    """Current product versions + category attributes, keyed by (start, key)."""
    pc = pc.select(F.col("id").alias("_pc_id"), "cat", "subcat", "maintenance")
    cur = pn.filter(F.col("prd_end_dt").isNull())
    j = cur.join(pc, cur.cat_id == pc._pc_id, "left")
    keyed = surrogate_key(j, [F.col(c).asc_nulls_first() for c in
                              ("prd_start_dt", "prd_key", "prd_id")], "product_key")
    return keyed.select(
        "product_key",
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        F.col("maintenance").alias("maintenance"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"))


FACT_COLUMNS = ("order_number", "product_key", "customer_key", "order_date", "shipping_date",
                "due_date", "sales_amount", "quantity", "price")


def fact_sales(sd: DataFrame, dp: DataFrame, dc: DataFrame,
               heavy: dict[str, DataFrame | None] | None = None) -> DataFrame:
    """Sales with surrogate keys looked up by business key (left joins).

    Shuffle joins when the dimensions are large; rows whose business key is
    NULL, or one of the ``heavy`` keys, carry a hashed salt so they spread over
    reducers instead of piling onto one (``lookup``).  With ``heavy`` (tables of
    heavy sls_cust_id and sls_prd_key) the rows also get the salts of their
    surrogate keys, c_salt and p_salt: hashed from the order number, so that an
    order's lines of one key stay together.
    """
    by = heavy or {}
    dp = dp.select(F.col("product_number").alias("sls_prd_key"), "product_key")
    dc = dc.select(F.col("customer_id").alias("sls_cust_id"), "customer_key")
    j = lookup(lookup(sd, dp, "sls_prd_key", "_p_", by.get("sls_prd_key")), dc, "sls_cust_id", "_c_",
               by.get("sls_cust_id"))
    if heavy is not None:
        j = skew.with_splits(skew.with_splits(j, "sls_prd_key", by.get("sls_prd_key"), "_ps"),
                             "sls_cust_id", by.get("sls_cust_id"), "_cs")
    out = j.select(
        F.col("sls_ord_num").alias("order_number"),
        F.col("_p_product_key").alias("product_key"), F.col("_c_customer_key").alias("customer_key"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
        *(["_cs", "_ps"] if heavy is not None else []))
    if heavy is None:
        return out
    parts = skew.partitions(sd)

    def salt(key: str, splits: str) -> Column:
        nowhere = F.pmod(F.xxhash64(*[F.col(c) for c in FACT_COLUMNS]), F.lit(parts))
        return (F.when(F.col(key).isNull(), nowhere)
                .when(F.col(splits) > 1, F.pmod(F.xxhash64("order_number"), F.col(splits)))
                .otherwise(0).cast("int"))

    return out.select(*FACT_COLUMNS, salt("customer_key", "_cs").alias("c_salt"),
                      salt("product_key", "_ps").alias("p_salt"))


CUSTOMER_GROUP = ("customer_id", "first_name", "last_name", "country")
PRODUCT_GROUP = ("product_name", "category", "subcategory", "product_line", "cost")


def keyed(dim: DataFrame, key: str, group: tuple[str, ...], business: str, salt: str,
          heavy: DataFrame | None = None) -> DataFrame:
    """A dimension laid out to meet the fact: key, salt (a row for each salt
    that rows of its heavy ``business`` key have), the reporting group, whether
    other keys share that group, and the smallest key of the group."""
    same = Window.partitionBy(*group)
    narrow = dim.select(key, *dict.fromkeys((*group, business))).withColumn(
        "shared", F.count(F.lit(1)).over(same) > 1).withColumn("group_key", F.min(key).over(same))
    return skew.replicated(narrow, business, heavy, salt).select(key, salt, *group, "shared", "group_key")


def customers_keyed(dc: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    return keyed(dc, "customer_key", CUSTOMER_GROUP, "customer_id", "c_salt", heavy)


def products_keyed(dp: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    return keyed(dp, "product_key", PRODUCT_GROUP, "product_number" if "product_number" in dp.columns
                 else "product_key", "p_salt", heavy)


def sales_by_product(fact: DataFrame) -> DataFrame:
    """The fact's columns that product questions need, dealt by product."""
    return fact.filter(F.col("order_date").isNotNull()).select(
        "product_key", "p_salt", "order_number", "order_date", "sales_amount", "quantity", "price")
