from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.cleanse import (
    ERP_GENDER, MARITAL, map_codes, normalize_country, null_after, parse_int_date, round_ratio,
    strip_prefix,
)
from strata.plans import silver


def test_parse_int_date_forms(spark):
    df = spark.createDataFrame([(20101229,), (0,), (32154,), (None,), (20101399,)], "d int")
    got = [r[0] for r in df.select(parse_int_date("d")).collect()]
    assert [str(x) if x else None for x in got] == ["2010-12-29", None, None, None, None]


def test_parse_int_date_strict_raises(spark):
    df = spark.createDataFrame([(20101399,)], "d int")
    with pytest.raises(Exception):
        df.select(parse_int_date("d", strict=True)).collect()


@pytest.mark.parametrize("sales,qty,price,exp_sales,exp_price", [
    (100, 2, 0, 0, 50),          # price 0: sales becomes 0, price from raw sales
    (None, 2, None, None, None),  # both NULL
    (10, 0, None, 10, None),      # qty 0: no divide error; NULL compare keeps sales
    (7, 2, None, 7, 3),           # integer division toward zero
    (-20, 2, 10, 20, 10),         # negative sales recomputed
    (21, 2, 10, 20, 10),          # inconsistent sales recomputed
    (20, 2, -10, 20, 10),         # negative price: raw sales / qty
])
def test_sales_rules(spark, sales, qty, price, exp_sales, exp_price):
    b = spark.createDataFrame(
        [("SO1", "P1", 1, 20200101, 20200102, 20200103, sales, qty, price)],
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, "
        "sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int")
    r = silver.crm_sales_details(b).first()
    assert (r.sls_sales, r.sls_price) == (exp_sales, exp_price)


def test_map_codes(spark):
    df = spark.createDataFrame([(" s ",), ("m",), ("X",), (None,)], "c string")
    assert [r[0] for r in df.select(map_codes("c", MARITAL)).collect()] == \
        ["Single", "Married", "n/a", "n/a"]
    df = spark.createDataFrame([("female ",), (" MALE",), ("f",), ("",)], "c string")
    assert [r[0] for r in df.select(map_codes("c", ERP_GENDER)).collect()] == \
        ["Female", "Male", "Female", "n/a"]


def test_country_prefix_future(spark):
    df = spark.createDataFrame([("DE",), ("USA ",), ("  ",), (None,), (" France ",)], "c string")
    assert [r[0] for r in df.select(normalize_country("c")).collect()] == \
        ["Germany", "United States", "n/a", "n/a", "France"]
    df = spark.createDataFrame([("NASAW1",), ("AW2",), ("nasAW3",)], "c string")
    assert [r[0] for r in df.select(strip_prefix("c", "NAS")).collect()] == ["AW1", "AW2", "nasAW3"]
    df = spark.createDataFrame([("2099-01-01",), ("2000-01-01",)], "d string").select(
        F.col("d").cast("date").alias("d"))
    assert [str(r[0]) for r in df.select(null_after("d", "2026-01-01")).collect()] == \
        ["None", "2000-01-01"]


def _py_round_ratio(n, d, digits, scale=100):
    if n is None or d in (None, 0):
        return None
    v = Decimal(scale) * Decimal(n) / Decimal(d)
    return float(v.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_round_ratio_matches_decimal(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(-10**9, 10**9), rnd.choice([0, rnd.randint(-10**6, 10**6)]))
            for _ in range(300)] + [(1, 8), (-1, 8), (5, 2000), (-5, 2000), (None, 3), (3, None)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", round_ratio(F.col("n"), F.col("d"), 2).alias("r")).collect()
    for r in got:
        assert r.r == _py_round_ratio(r.n, r.d, 2), (r.n, r.d, r.r)


def test_parse_int_date_matches_text_parse(spark):
    """The arithmetic path equals the text rule on random and edge values."""
    import random
    rnd = random.Random(11)
    vals = [rnd.randint(-10**8, 10**8) for _ in range(3000)]
    vals += [rnd.randint(10000101, 99991231) for _ in range(3000)]
    vals += [y * 10000 + m * 100 + d for y in (1900, 2000, 2023, 2024, 9999)
             for m in (0, 1, 2, 12, 13) for d in (0, 1, 28, 29, 30, 31, 32)]
    vals += [None, 0, 10000000, 99999999, -10000000, 2147483647, -2147483648]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    text = F.col("v").cast("string")
    ref = F.when((F.col("v") == 0) | (F.length(text) != 8), F.lit(None).cast("date")).otherwise(
        F.try_to_date(text, "yyyyMMdd"))
    bad = df.select(parse_int_date("v").alias("a"), ref.alias("b")).filter(
        ~F.col("a").eqNullSafe(F.col("b"))).count()
    assert bad == 0
