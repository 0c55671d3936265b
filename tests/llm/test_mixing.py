import hashlib

import duckdb
import numpy as np
import pytest

from strata.llm import mixing as M
from tests.llm.helpers import rows

D = "/root/testdata/sf0.01"


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    want = sorted(con.execute(M.ORACLE).fetchall())
    got = sorted(tuple(r) for r in M.query(spark, D).collect())
    assert got == want and len({r[3] for r in got}) == 4


def plain(n, targets, keep):
    """Rates by cell: categories in turn, cells at 1 kept whole, until settled."""
    total = sum(n.values())
    want = [{v: x * keep * total for v, x in t.items()} for t in targets]
    f = [{v: keep for v in t} for t in targets]
    last = float("inf")
    for k in range(1, M.ROUNDS + 1):
        worst = 0
        for d in range(3):
            mass = {}
            for c, x in n.items():
                r = f[0][c[0]] * f[1][c[1]] * f[2][c[2]]
                part = mass.setdefault(c[d], [0.0, 0.0])
                part[r < 1] += x * min(r, 1)
            for v, (fixed, free) in mass.items():
                t = want[d][v]
                if t and not (t > fixed and not free):
                    worst = max(worst, abs((fixed + free) / t - 1))
                if t > fixed and free:
                    f[d][v] *= (t - fixed) / free
                elif t <= fixed and fixed + free:
                    f[d][v] *= t / (fixed + free)
        if worst <= M.SETTLED or (k >= M.PATIENCE and worst > M.STALLED * last):
            break
        last = worst
    return {c: min(1.0, f[0][c[0]] * f[1][c[1]] * f[2][c[2]]) for c in n}


def shares(n, temper):
    total = sum(n.values())
    out = []
    for d, k in enumerate(M.DIMS):
        raw = {v: (sum(x for c, x in n.items() if c[d] == v) / total) ** temper[k] for v in {c[d] for c in n}}
        out.append({v: x / sum(raw.values()) for v, x in raw.items()})
    return out


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_rates_meet_targets(spark, monkeypatch, most):
    monkeypatch.setattr(M, "WINDOW_CELLS", most)
    data = [(i, "a b c " * (1 + i % 4), f"s{i % 3}", "en" if i % 5 else None, t)
            for i in range(300) for t in ("x", "y") if (i + len(t)) % 7 or t == "x"]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, topic string")
    want = {"s0": 0.2, "s1": 0.5, "s2": 0.3, "absent": 5.0}
    given = spark.createDataFrame(list(want.items()), "value string, share double")
    cells = df.withColumn("tokens", M.tokens_of())
    r = M.rates(cells, targets={"source": given}, temper={"lang": 0.4, "topic": 1.0}, keep=0.3).toPandas()
    n = cells.groupBy("source", "lang", "topic").agg({"tokens": "sum"}).toPandas()
    both = n.merge(r, on=["source", "lang", "topic"])
    both["w"] = both["sum(tokens)"] * both["rate"]
    assert both["w"].sum() == pytest.approx(0.3 * both["sum(tokens)"].sum(), rel=1e-3)
    both["w"] /= both["w"].sum()
    by = both.groupby("source")["w"].sum()
    assert by["s1"] == pytest.approx(0.5, rel=1e-3) and by["s0"] == pytest.approx(0.2, rel=1e-3)
    count = {(c.source, None if c.lang != c.lang else c.lang, c.topic): c.n for c in n.rename(
        columns={"sum(tokens)": "n"}).itertuples()}
    share = shares(count, {"source": 1.0, "lang": 0.4, "topic": 1.0})
    share[0] = {v: want[v] for v in share[0]}
    exact = plain(count, share, 0.3)
    for c in r.itertuples():
        assert c.rate == pytest.approx(exact[c.source, None if c.lang != c.lang else c.lang, c.topic], abs=1e-9)


def test_sample_keeps_what_mix_keeps(spark):
    data = [(i, None if i % 11 == 0 else "licence text" if i % 3 else " a | b ", None if i % 4 else "q", "en", "x")
            for i in range(200)] + [(5, "same", "q", "en", "x"), (5, "same", "q", "en", "x"), (None, "", "q", "de", "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, rate string").repartition(3)
    got = M.sample(df)
    assert got.columns == df.columns
    every = M.mix(df)
    assert every.count() == len(data)
    kept = sorted(str(r["doc_id"]) for r in rows(every, "doc_id") if r["kept"])
    assert sorted(str(r.doc_id) for r in got.collect()) == kept and 0 < len(kept) < len(data)
    unit = int(hashlib.md5(b"mix:17").hexdigest()[:8], 16) / 2**32
    assert df.filter("doc_id = 17").select(M.unit_of().alias("u")).first().u == unit


def test_unnamed_category_gets_nothing_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "s", "en"), (2, "a", "t", "en")],
                               "doc_id long, text string, source string, lang string")
    given = spark.createDataFrame([("s", 1.0)], "value string, share double")
    with pytest.warns(UserWarning):
        assert [r.doc_id for r in M.mix(df, targets={"source": given}).collect() if r.rate > 0] == [1]
    assert M.mix(df.limit(0)).count() == 0 and M.sample(df.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    plan = M.sample(spark.read.parquet(f"{D}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_stray_document_does_not_scale_all(spark):
    data = [(i, "a b c d", f"s{i % 20 if i % 3 else 0}", "en" if i % 10 < 6 else "de") for i in range(10000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    stray = spark.createDataFrame([(10000, "a b c d", None, "xx")], df.schema)
    kept = []
    for docs in (df, df.unionAll(stray)):
        got = M.mix(docs).selectExpr("avg(tokens * rate) / avg(tokens) AS w", "max(rate) AS m",
                                     "count_if(kept) AS n").first()
        assert got.w == pytest.approx(0.6, abs=2e-3) and got.m <= 1 and got.n == pytest.approx(6000, abs=250)
        kept.append(got.n)
    assert abs(kept[1] - kept[0]) < 0.02 * kept[0]


def test_targets_that_can_be_met_are_met_although_cells_are_kept_whole(spark):
    """The rare language is short of weight: its cells are kept whole, and the
    others are raked again, so sources and the total still meet their targets."""
    data = [(i, "a", f"s{i % 2}", "en" if i % 50 else "fr") for i in range(5000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    given = spark.createDataFrame([("en", 0.9), ("fr", 0.1)], "value string, share double")
    with pytest.warns(UserWarning, match="lang is missed"):
        got = M.mix(df, targets={"lang": given}, keep=0.6).toPandas()
    assert set(got[got.lang == "fr"].rate) == {1.0}
    by = got.groupby("source")["rate"].sum()
    assert by["s0"] == pytest.approx(by["s1"], rel=0.01) and got.rate.sum() == pytest.approx(3000, rel=0.01)


def test_keep_meets_targets_or_warns(spark):
    data = [(i, "a", f"s{i % 2}", "en") for i in range(100)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    given = spark.createDataFrame([("s0", 0.9), ("s1", 0.1)], "value string, share double")
    with pytest.warns(UserWarning, match="source is missed"):
        rate = {r.source: r.rate for r in M.mix(df, targets={"source": given}, keep=0.8).collect()}
    assert rate["s0"] == 1.0
    assert M.sample(df.limit(0), keep=0.6).count() == 0
