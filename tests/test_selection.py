"""k-th rows by histograms equal the rows of a full sort."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import selection
from strata.operators.ranking import multi_ntile


def ntiles(df, tiles, keys, unique):
    for name, (c, up) in keys.items():
        first = F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last()
        df = df.withColumn(name, F.ntile(tiles).over(
            Window.orderBy(first, *[F.col(u).asc_nulls_first() for u in unique])).cast("long"))
    return df


def same(got, want):
    return got.exceptAll(want).count() == want.exceptAll(got).count() == 0


KEYS = {"r": ("a", True), "f": ("a", False), "m": ("b", False)}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-4, 4)),
                               st.one_of(st.none(), st.integers(-2**40, 2**40))), max_size=50),
       fetch=st.sampled_from([0, 1, 3, 1 << 16]), buckets=st.sampled_from([2, 5, 4096]))
def test_multi_ntile_equals_windows(spark, rows, fetch, buckets):
    data = [(None if i % 5 == 0 else i // 3, f"s{i % 4}" if i % 7 else None, f"u{i}", a, b)
            for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, s string, u string, a int, b long")
    old = selection.BUCKETS, selection.kth_rows.__defaults__
    selection.BUCKETS, selection.kth_rows.__defaults__ = buckets, (fetch,)
    try:
        got = multi_ntile(df, 5, KEYS, ["id", "s", "u"])
        assert same(got, ntiles(df, 5, KEYS, ["id", "s", "u"]))
    finally:
        selection.BUCKETS, selection.kth_rows.__defaults__ = old


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6])
def test_few_rows(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 2).alias("a"), F.lit(None).cast("int").alias("b"))
    assert same(multi_ntile(df, 5, KEYS, ["id"]), ntiles(df, 5, KEYS, ["id"]))


def test_ties_beyond_the_fetch_limit_are_refined(spark):
    """One key value on all rows, one id on a third of them: the rest decides."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("id"), F.lit(1).alias("a"),
        F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("nm"), (-F.col("id")).alias("b"))
    calls = []
    plain, old = selection._histograms, selection.kth_rows.__defaults__
    selection.kth_rows.__defaults__ = (64,)
    selection._histograms = lambda *a: (calls.append(len(a[2])), plain(*a))[1]
    try:
        got = multi_ntile(df, 5, KEYS, ["id", "nm"])
        assert same(got, ntiles(df, 5, KEYS, ["id", "nm"]))
    finally:
        selection._histograms, selection.kth_rows.__defaults__ = plain, old
    assert 1 <= len(calls) <= 5


def test_no_sort_and_no_copy_of_the_rows(spark):
    df = spark.range(50000).select("id", (F.col("id") * 7919 % 100003).alias("a"), (F.col("id") % 3).alias("b"))
    text = multi_ntile(df, 5, KEYS, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text and "Generate" not in text
