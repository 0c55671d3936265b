import random

import numpy as np
import pytest

from strata.llm import neardup as N
from tests.llm.helpers import rows, words

D = "/root/testdata/sf0.001"


def shingle_set(t, n):
    w = words(t)
    return {tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(docs, n, percent):
    sets = [shingle_set(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted((dict(doc_id=d, n_shingles=len(sets[i]), component_id=low.get(root(i)),
                        kept=None if d is None or root(i) not in low else d == low[root(i)])
                   for i, (d, _) in enumerate(docs)),
                  key=lambda r: (str(r["doc_id"]), str(r["n_shingles"])))


def made(seed=3):
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randint(0, 400)
    docs = []
    for g in range(12):
        base = [word() for _ in range(rnd.choice([3, 20, 60, 200]))]
        for _ in range(rnd.choice([1, 2, 9, 40])):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 25))):
                t[rnd.randrange(len(t))] = word()
            docs.append((len(docs) * 7 % 1000, " ".join(t)))
    chain = [word() for _ in range(120)]
    for k in range(30):  # each is near the next, the ends are far apart
        docs.append((2000 - k, " ".join(chain)))
        chain[4 * k % 120] = word()
    docs += [(3000, None), (3001, ""), (3002, " \n"), (3003, "One"), (3004, "one"), (3005, "two words"),
             (None, "null id text of its own kind here"), (3006, "A b  c d"), (3006, "a B c d"),
             (3007, docs[0][1])]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("block,n,percent", [(2048, 3, 85), (3, 3, 85), (2048, 5, 80)])
def test_equals_brute_force(spark, monkeypatch, block, n, percent):
    monkeypatch.setattr(N, "BLOCK", block)
    docs = made()
    df = spark.createDataFrame([(*d, True, "x") for d in docs],
                               "doc_id long, text string, kept boolean, node string").repartition(5)
    assert rows(N.groups(df, n, percent), "doc_id", "n_shingles") == brute(docs, n, percent)


def test_registered_query_on_real_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    assert rows(N.query(spark, D), "doc_id", "n_shingles") == brute(docs, 3, 85)


def test_keep_one(spark):
    docs = made()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, _node string")
    got = N.keep_one(df, 5, 80)
    assert got.columns == df.columns
    want = {r["doc_id"] for r in brute(docs, 5, 80) if r["kept"]} | {None}
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == want


def test_empty_and_no_links(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert N.groups(df).count() == 0 and N.keep_one(df).count() == 0
    one = spark.createDataFrame([(1, "a b c d"), (2, None)], "doc_id long, text string")
    assert [(r.component_id, r.kept) for r in N.groups(one).orderBy("doc_id").collect()] == [(1, True), (2, True)]


def test_estimate_follows_similarity(spark):
    a = " ".join(f"a{i}" for i in range(2000))
    b = " ".join(f"a{i}" if i % 100 else f"b{i}" for i in range(2000))
    df = spark.createDataFrame([(1, a), (2, b), (3, " ".join(f"c{i}" for i in range(900)))],
                               "doc_id long, text string")
    nodes = N.fingerprints(df, 3).select("doc_id", "node")
    p = N.deep(df.join(nodes, "doc_id"), 3, 16).join(nodes, "node").select("doc_id", "sig")
    q = p.toDF("d2", "sig2")
    est = {(r.doc_id, r.d2): r.e for r in p.join(q).select("doc_id", "d2", N.estimate("sig", "sig2").alias("e")).collect()}
    assert est[1, 1] == 1 and abs(est[1, 2] - 0.94) < 0.04 and abs(est[1, 3]) < 0.12


def test_deep_rows_keep_the_loss_bound():
    for percent in (80, 85, 95):
        r = N.deep_rows(percent)
        assert (1 - (percent / 100) ** r) ** (N.DEEP // r) <= N.MISS and r >= 5


def test_deep_minima_are_taken_in_blocks(monkeypatch):
    """What a task holds at once does not follow the rows of its batch."""
    import pyarrow as pa

    from strata.llm import neardup as N
    texts = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(20)) for i in range(700)]
    col = pa.array(texts)
    nodes = [N._digest(s[e - c:e]) for _, s, counts in N._sets(col, 3)
             for e, c in zip(np.cumsum(counts).tolist(), counts.tolist())]
    batch = pa.RecordBatch.from_arrays([col, pa.array(nodes, pa.binary())], names=["text", "node"])
    monkeypatch.setattr(N, "arrow_map", lambda docs, run, schema: run)
    sizes = []
    monkeypatch.setattr(N, "_minima", lambda s, first, perms, f=N._minima: sizes.append(len(first)) or f(s, first, perms))
    got = pa.Table.from_batches(list(N.deep(None, 3, 16)(batch)))
    assert sum(sizes) == got.num_rows == len(texts) and max(sizes) <= 256
    assert got["node"].to_pylist() == nodes
    one = pa.Table.from_batches([b for i in range(len(texts)) for b in N.deep(None, 3, 16)(batch.slice(i, 1))])
    assert one.equals(got.combine_chunks()) or one.to_pydict() == got.to_pydict()
