import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import merkle as K
from tools.compare import rows_of

COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc, source, lang, n, _ = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def climb(level):
    """(root, siblings of every node from it to the root) of one tree."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for way, k in zip(ways, at, strict=True):
            run = level[k // 8 * 8:k // 8 * 8 + 8]
            way.append((run[:k % 8], run[k % 8 + 1:]))
        level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
        at = [k // 8 for k in at]
    return level[0], ways


def plain(rows):
    low = {c: c + 32 for c in range(65, 91)}
    trees, out = {}, []
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    done = []
    for g in order:
        trees[g].sort(key=lambda x: x[:3])
        done.append(climb([x[2] for x in trees[g]]))
    root, tops = climb([d[0] for d in done])
    for g, (sub, ways), top in zip(order, done, tops, strict=True):
        for (_, _, own, r), way in zip(trees[g], ways, strict=True):
            doc, text = r[0], r[4]
            hit = zlib.crc32(str("" if doc is None else doc).encode()) % 3 == 0
            node = leaf(r, text.translate(low) if hit and text is not None else text)
            for a, b in [*way, *top]:
                node = sha("".join(a) + node + "".join(b))
            said = "".join("".join(a) + "".join(b) for a, b in [*way, *top])
            out.append((doc, own, sub, root, sha(said), node, node == root))
    return sorted(out, key=str)


def answer(spark, rows, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    got = sorted((tuple(r[c] for c in COLS) for r in K.query(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    res = con.execute(K.ORACLE)
    assert sorted(d[0] for d in res.description) == sorted(COLS)
    names = [d[0] for d in res.description]
    assert rows_of(res.fetchall(), names) == rows_of(got, list(COLS))
    return got


CASES = {
    "odd": [(1, "s", "en", 3, "ABC"), (2, None, "en", None, None), (3, "", "en", 0, ""), (None, "s", None, 1, "Null Id"),
            (4, "s", "ß", 2, "ÀB"), (4, "s", "ß", 2, "ÀB"), (4, "s", "ß", 2, "other"), (-7, "s", "z", 5, "lone Leaf"),
            (9, "s", "en", 9, "x" * 70000)],
    "one row": [(5, "s", "en", 1, "A")],
    "one language": [(k, "s", "en", k, f"Text {k}") for k in range(65)],
    "runs of one": [(k, "s", f"l{k % 9}", k, f"T{k}") for k in range(9 * 9)],
    "one id, equal rows": [(1, "s", "en", 1, "Same")] * 70 + [(k, "s", None, 1, "Y") for k in range(9)],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_plain_and_sql(spark, tmp_path, case):
    assert answer(spark, CASES[case], tmp_path) == plain(CASES[case])


def test_empty(spark, tmp_path):
    assert answer(spark, [], tmp_path) == []


def test_some_requests_and_a_forged_proof(spark):
    rows = [(k, "s", "en" if k % 3 else "de", k, f"T{k}") for k in range(300)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    m = K.build(docs)
    got = K.prove(m, m.leaves.filter("doc_id % 50 = 0"))
    out = got.select("doc_id", (K.folded(F.col("leaf")) == m.root).alias("ok"),
                     (K.folded(F.sha2("leaf", 256)) == m.root).alias("forged")).collect()
    assert sorted(r.doc_id for r in out) == [0, 50, 100, 150, 200, 250]
    assert all(r.ok and not r.forged for r in out)
    want = {r[0]: r[4] for r in plain(rows)}
    for r in got.select("doc_id", K.proof_digest().alias("p")).collect():
        assert r.p == want[r.doc_id]


def test_equal_subtrees_share_a_record(spark):
    m = K.build(spark.createDataFrame([(1, "s", "en", 1, "Same", 1, "x")] * 640, SCHEMA))
    low = m.nodes.filter("tree = 'lang' AND height = 1")
    assert low.count() == 80 and low.distinct().count() == 1
