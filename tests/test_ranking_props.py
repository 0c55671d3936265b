"""Property tests: distributed ranking equals Spark's single-partition window."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest
from strata.operators.ranking import global_ntile, global_rank, global_row_number

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab", " b"]))),
                min_size=0, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame([(i, a, s) for i, (a, s) in enumerate(rows)],
                                 "id long, a int, s string")


def _mismatches(got, exp, col_got, col_exp):
    return got.join(exp.select("id", col_exp), "id").filter(
        ~F.col(col_got).eqNullSafe(F.col(col_exp))).count()


@SETTINGS
@given(rows=ROWS, a_desc=st.booleans(), s_desc=st.booleans())
def test_row_number_and_ntile_composite(spark, rows, a_desc, s_desc):
    df = _df(spark, rows)
    order = [F.col("a").desc_nulls_last() if a_desc else F.col("a").asc_nulls_first(),
             F.col("s").desc_nulls_last() if s_desc else F.col("s").asc_nulls_first(),
             F.col("id").asc()]
    w = Window.orderBy(*order)
    exp = df.select("id", F.row_number().over(w).alias("e_rn"), F.ntile(4).over(w).alias("e_nt"))
    got = global_row_number(df, order, out="rn")
    assert got.count() == len(rows)
    assert _mismatches(got, exp, "rn", "e_rn") == 0
    assert _mismatches(global_ntile(df, 4, order, "nt"), exp, "nt", "e_nt") == 0


@SETTINGS
@given(rows=ROWS, desc=st.booleans())
def test_rank_string_keys(spark, rows, desc):
    df = _df(spark, rows)
    key = F.col("s").desc_nulls_last() if desc else F.col("s").asc_nulls_first()
    exp = df.select("id", F.rank().over(Window.orderBy(key)).alias("e_rk"))
    got = global_rank(df, ["s"], [not desc], [F.col("id").asc()], "rk")
    assert got.count() == len(rows)
    assert _mismatches(got, exp, "rk", "e_rk") == 0


@SETTINGS
@given(rows=ROWS)
def test_dedup_one_row_per_key(spark, rows):
    df = _df(spark, rows)
    out = dedup_latest(df, ["a"], [F.col("s").desc_nulls_last(), F.col("id").asc()])
    keys = [r.a for r in out.collect()]
    assert len(keys) == len(set(keys)) == len({a for a, _ in rows})


def test_hot_leading_value_is_split(spark):
    """A value holding a third of the rows spreads over several ranges."""
    n = 30000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7)
                               .otherwise(F.col("id")).alias("k"))
    order = [F.col("k").asc(), F.col("id").asc()]
    parts = (df.repartitionByRange(8, *order).select(F.spark_partition_id().alias("p"), "k")
             .filter(F.col("k") == 7).groupBy("p").count().collect())
    assert len(parts) >= 2
    assert max(r["count"] for r in parts) < n / 3
    got = global_row_number(df, order, out="rn", num_ranges=8)
    assert got.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, n, n)
