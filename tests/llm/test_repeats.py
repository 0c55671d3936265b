import random
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import repeats as R
from strata.llm import text as X
from tests.llm.helpers import words

D = "/root/testdata/sf0.001"


def merged(docs, n=50):
    """Spans as maximal unions of overlapping or touching passages."""
    where, toks = defaultdict(set), defaultdict(set)
    every = [(d, words(t)) for d, t in docs]
    for d, w in every:
        for i in range(len(w) - n + 1):
            where[tuple(w[i:i + n])].add(d)
    for d, w in every:
        toks[d] |= {i for i in range(len(w) - n + 1) if len(where[tuple(w[i:i + n])]) > 1}
    out = set()
    for d, s in toks.items():
        s = sorted(s)
        k = 0
        while k < len(s):
            j = k
            while j + 1 < len(s) and s[j + 1] <= s[j] + n:
                j += 1
            out.add((d, s[k], s[j] + n))
            k = j + 1
    return out


def got(df):
    rows = df.collect()
    assert all(r.n_words == r.end - r.start >= 50 for r in rows)
    return {(r.doc_id, r.start, r.end) for r in rows}


def made(seed=4):
    rnd = random.Random(seed)
    text = lambda n, v=3000: " ".join("w%d" % rnd.randint(0, v) for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 57, 64, 80, 200)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts += [text(rnd.randint(0, 90)), rnd.choice(passages)]
        docs.append((i, "\n".join([*parts, text(rnd.randint(0, 200))])))
    docs += [(100 + i, docs[7][1].upper()) for i in range(4)]                   # copies
    docs += [(200 + i, "a b " * 300) for i in range(3)]                         # periodic
    docs += [(210, "same line of words here " * 60)]                            # repeats only itself
    p = passages[6].split()
    docs += [(300, text(30) + " " + " ".join(p[100:153]) + " " + text(30)),    # cut from the middle
             (301, " ".join(p[:60] + ["x"] + p[61:])),
             (400, None), (401, ""), (402, "short"), (None, passages[5]), (None, passages[5]),
             (403, text(80)), (403, text(80)), (404, "k " + passages[1]), (404, passages[1])]
    return docs


def test_equals_brute_force(spark):
    docs = made()
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, start int").repartition(5)
    assert got(R.spans(df)) == merged(docs)


def test_small_batches_leave_runs_open(spark):
    docs = made(9)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        df = spark.createDataFrame(docs, "doc_id long, text string")
        assert got(R.spans(df)) == merged(docs)
    finally:
        spark.conf.set(key, old)


def test_registered_query_on_real_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    want = merged(docs)
    assert got(R.query(spark, D)) == want and want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert R.spans(df).count() == 0


@pytest.mark.parametrize("vocab", [2, 3000])
def test_every_passage_holds_a_retained_suffix(vocab):
    rng = np.random.default_rng(1)
    col = __import__("pyarrow").array([" ".join(f"w{i}" for i in rng.integers(0, vocab, n))
                                       for n in (10, 49, 50, 51, 700, 3)])
    for w in X.words(col):
        at, row = R.retained(w)
        for r, n in enumerate(w.counts):
            mine = set((at[row == r] - w.offsets[r]).tolist())
            for i in range(n - 50 + 1):
                assert mine & set(range(i, i + R.SPREAD))
