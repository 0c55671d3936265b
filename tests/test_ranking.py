import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.ranking import global_ntile, global_rank, global_row_number, next_in_sequence


def _frame(spark, n=500, seed=1, hot=False):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = 7 if hot and i % 3 == 0 else rnd.choice([None, *range(20)])
        rows.append((i, a, rnd.choice(["x", "y", "zz", None]), rnd.randint(-5, 5)))
    return spark.createDataFrame(rows, "id long, a int, s string, v int")


def _check_same(df, ranked, expected_col, got_col):
    bad = ranked.join(df.select("id", expected_col), "id").filter(
        F.col(got_col) != F.col(expected_col)).count()
    assert bad == 0


def test_row_number_matches_window(spark):
    df = _frame(spark, hot=True)
    order = [F.col("a").desc_nulls_last(), F.col("s").asc_nulls_first(), F.col("id").asc()]
    exp = df.withColumn("exp", F.row_number().over(Window.orderBy(*order)))
    got = global_row_number(df, order, out="rn", num_ranges=7)
    assert got.count() == df.count()
    _check_same(exp, got, "exp", "rn")


def test_ntile_matches_window(spark):
    for n, tiles in ((500, 5), (7, 5), (3, 5), (11, 4)):
        df = _frame(spark, n=n, seed=n)
        order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
        exp = df.withColumn("exp", F.ntile(tiles).over(Window.orderBy(*order)))
        got = global_ntile(df, tiles, order, "tile")
        _check_same(exp, got, "exp", "tile")


def test_ntile_remainder_layout(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    got = global_ntile(df, 5, [F.col("k").asc()], "t").orderBy("k").collect()
    assert [r.t for r in got] == [1, 1, 2, 2, 3, 4, 5]


def test_rank_matches_window_with_ties(spark):
    df = _frame(spark, hot=True)
    exp = df.withColumn("exp", F.rank().over(Window.orderBy(F.col("a").desc_nulls_last())))
    got = global_rank(df, ["a"], [False], [F.col("id").asc()], "rk")
    assert got.count() == df.count()
    _check_same(exp, got, "exp", "rk")


def test_lead_matches_window(spark):
    df = _frame(spark, hot=True)
    w = Window.partitionBy("a").orderBy(F.col("v").asc_nulls_first(), F.col("id").asc())
    exp = df.withColumn("exp", F.lead("v").over(w))
    # tiny chunks put many group and chunk boundaries next to each other
    for chunk in (1_000_000, 7, 2, 1):
        got = next_in_sequence(df, "a", [F.col("v").asc_nulls_first(), F.col("id").asc()], ["v"],
                               chunk_rows=chunk)
        assert got.count() == df.count()
        bad = got.join(exp.select("id", "exp"), "id").filter(
            ~F.col("next_v").eqNullSafe(F.col("exp"))).count()
        assert bad == 0, chunk


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, a int")
    assert global_row_number(df, [F.col("id").asc()]).count() == 0
    assert global_ntile(df, 5, [F.col("id").asc()], "t").count() == 0


def test_drop_scratch_removes_ranking_intermediates(spark):
    import os

    from strata.operators.ranking import scratch_root
    from strata.plans.warehouse import Warehouse
    df = spark.range(50).withColumnRenamed("id", "k")
    assert global_row_number(df, [F.col("k").asc()]).count() == 50
    root = scratch_root(spark)
    local = root[len("file:"):] if root.startswith("file:") else root
    assert os.path.isdir(local) and os.listdir(local)
    Warehouse(spark, "/root/testdata/sf0.001").drop_scratch()
    assert not os.path.exists(local)


def test_multi_ntile_matches_windows(spark):
    from strata.operators.ranking import multi_ntile
    import random as _r
    rnd = _r.Random(5)
    rows = [(i, f"n{i % 7}", rnd.choice([None, 1, 2, 3]), rnd.randint(0, 4),
             rnd.choice([None, *range(10)])) for i in range(157)]
    df = spark.createDataFrame(rows, "id long, nm string, a int, b long, c long")
    keys = {"ta": ("a", True), "tb": ("b", False), "tc": ("c", False)}
    got = multi_ntile(df, 5, keys, ["id", "nm"])
    assert got.count() == len(rows) and got.columns == df.columns + list(keys)
    exp = df
    for name, (col, asc) in keys.items():
        o = F.col(col).asc_nulls_first() if asc else F.col(col).desc_nulls_last()
        exp = exp.withColumn("e_" + name, F.ntile(5).over(Window.orderBy(o, F.col("id"), F.col("nm"))))
    j = got.join(exp.select("id", *["e_" + k for k in keys]), "id")
    for name in keys:
        assert j.filter(F.col(name) != F.col("e_" + name)).count() == 0
