import hashlib
import random
import re

import pytest

from strata.llm import decontaminate as D
from tests.llm.helpers import lower_az, rows

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, items, n=10):
    wins = []
    for i, t in items:
        w = WORDS.findall(lower_az(t or ""))
        m = min(n, len(w))
        wins += [(i, tuple(w[k:k + m])) for k in range(len(w) - m + 1) if m]
    out = []
    for d, t in docs:
        w = WORDS.findall(lower_az(t or ""))
        hit, who = set(), set()
        for i, p in wins:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    if i is not None:
                        who.add(str(i))
        sha = hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()
        out.append(dict(doc_id=d, n_words=len(w), n_hit=len(hit), n_items=len(who),
                        items_sha256=sha, contaminated=bool(hit)))
    return sorted(out, key=lambda r: (str(r["doc_id"]), str(r["n_words"])))


def made(seed=5, n_docs=60, n_items=25):
    rnd = random.Random(seed)
    vocab = ["a", "b", "the", "of", "Äpfel", "x1", "THE", "zz"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([1, 3, 9, 10, 11, 30])) if i % 5 else text(10)) for i in range(n_items)]
    items = [x for x in items if len(x[1].split()) > 2]
    items += [(900, None), (901, "--- !!"), (902, items[0][1]), (None, text(12))]
    docs = [(i, text(rnd.randint(0, 700))) for i in range(n_docs)]
    docs += [(1000 + k, text(40) + "\n" + (t or "") + "; " + text(30)) for k, (i, t) in enumerate(items)]
    docs += [(2000, None), (2001, ""), (2002, "!!! ..."), (None, items[1][1]), (5, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 150])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    docs, items = made()
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int")
    bm = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    got = rows(D.report(df, bm), "doc_id", "n_words")
    assert got == brute(docs, items)
    clean = D.clean(df, bm)
    assert clean.columns == df.columns
    want = [r["doc_id"] for r in brute(docs, items) if not r["contaminated"]]
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(map(str, want))


def test_registered_query_on_real_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert rows(D.query(spark, d), "doc_id", "n_words") == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bm = spark.createDataFrame([], "item_id long, text string")
    assert D.report(none, bm).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.contaminated for r in D.report(some, bm).collect()] == [False]
