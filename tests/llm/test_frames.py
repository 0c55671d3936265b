import os
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import frames, text as X
from strata.llm.components import contract
from tests.llm.helpers import words


def test_scratch_tables_go_when_dropped(spark):
    s = frames.Scratch(spark, "t")
    a = s.write(spark.range(5))
    b = s.write(a.filter("id > 2"))
    local = s.root.removeprefix("file:")
    assert b.count() == 2 and len(os.listdir(local)) == 2
    s.drop(a)
    assert len(os.listdir(local)) == 1 and b.count() == 2
    frames.drop_all(spark)
    assert not os.path.exists(local)


def test_small_hints_only_behind_its_size(spark):
    df = spark.range(10)
    plan = lambda rows: spark.range(10).join(frames.small(df, rows, 1 << 20), "id")._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in plan(10) and "ResolvedHint" not in plan(17)


def test_crc_mod(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", frames.crc_mod(df["doc_id"], 7).alias("m")).collect():
        assert r.m == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbZ é\n\t\x0b\x1c漢", max_size=30)), max_size=8))
def test_words_equal_regex_words(texts):
    got = {}
    for w in X.words(pa.array(texts, pa.string()), limit=7):
        for r in range(len(w.counts)):
            a, b = w.offsets[r], w.offsets[r + 1]
            got[w.first + r] = [bytes(w.buf[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])]
    assert [got[i] for i in range(len(texts))] == [words(t) for t in texts]


def test_hash_does_not_depend_on_place(monkeypatch):
    base = ["alpha", "beta", "alpha", "x" * 5000, "beta", "x" * 5000]
    whole = next(iter(X.words(pa.array([" ".join(base)]))))
    monkeypatch.setattr(X, "SLICE", 64)
    cut = next(iter(X.words(pa.array([" ".join(base)]), limit=64)))
    assert (whole.hash == cut.hash).all() and len(set(whole.hash.tolist())) == 3


def test_contract_finds_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000 + i, 1000) for i in range(1, 200)]
    links += [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(180)] + [(5, 5), (1, 0)]
    s = frames.Scratch(spark, "cc")
    got = {r.node: r.label for r in contract(spark.createDataFrame(links, "a long, b long"), s).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        up[root(a)] = root(b)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got.keys() == nodes
    by = {}
    for x in nodes:
        by.setdefault(root(x), set()).add(got[x])
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)
    empty = contract(spark.createDataFrame([], "a long, b long"), s)
    assert empty.columns == ["node", "label"] and empty.count() == 0


def test_shingles_of_short_rows():
    w = next(iter(X.words(pa.array(["a b", "a b c", "", "b", "a  B"]))))
    s, n = X.shingles(w, 3)
    assert n.tolist() == [1, 1, 0, 1, 1] and s[0] == s[3] and len(np.unique(s)) == 3


def test_dropping_an_unwritten_frame_drops_nothing(spark):
    """Also if it has the id of a written frame that is gone."""
    scratch = frames.Scratch(spark, "test")
    paths = [scratch.write(spark.range(3)).inputFiles()[0] for _ in range(5)]
    for _ in range(50):
        scratch.drop(spark.range(1))
    assert all(spark.read.parquet(p).count() >= 0 for p in paths)
