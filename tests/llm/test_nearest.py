import numpy as np
import pytest

from strata.llm import nearest as A

D = "/root/testdata/sf0.1"


def brute(data):
    own = {}
    for i, v in data:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        own[i] = np.array(v, np.float64)
    size = max({len(v) for v in own.values()}, key=lambda d: (sum(len(v) == d for v in own.values()), d), default=0)
    own = {i: v for i, v in own.items() if len(v) == size}
    out = {}
    for q in own:
        if q % 50 == 0:
            s = [(-float((own[q] * v).sum() / (np.sqrt((own[q] ** 2).sum()) * np.sqrt((v ** 2).sum()))), i)
                 for i, v in own.items() if i != q]
            out[q] = [(i, -x) for x, i in sorted((round(x, 12), i) for x, i in s)[:5]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{D}/embeddings.parquet").collect()]
    want, have = brute(data), got(A.query(spark, D))
    assert have.keys() == want.keys() and all(len(v) == 5 for v in have.values())
    hits = sum(len({i for i, _ in have[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {q: dict(v) for q, v in want.items()}
    for q, v in have.items():
        assert [s for _, s in v] == sorted((s for _, s in v), reverse=True)
        assert all(s == pytest.approx(exact[q][i], abs=1e-12) for i, s in v if i in exact[q])


@pytest.mark.parametrize("blocks", [(8192, 1024), (7, 3)])
def test_copies_ties_and_odd_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(A, "ENTRY_BLOCK", blocks[0])
    monkeypatch.setattr(A, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(A, "RECALL", 1.0)
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    same = data[3][1]
    data += [(1000 + i, same) for i in range(200)]  # a third are one vector
    data += [(2000 + i, [2.0 * x for x in same]) for i in range(60)]
    data += [(5000, None), (5050, [0.0] * 8), (5100, [float("nan")] + [1.0] * 7), (5150, [None] + [1.0] * 7),
             (5200, [float("inf")] * 8), (5250, [1.0] * 3), (None, [1.0] * 8), (50, data[50][1]), (5300, [])]
    df = spark.createDataFrame([(*d, 1) for d in data], "vec_id long, embedding array<float>, rank int").repartition(5)
    want, have = brute(data), got(A.search(df))
    assert have.keys() == want.keys()
    for q in want:  # every sampled query has full recall; the copies are exact
        assert [s for _, s in have[q]] == pytest.approx([s for _, s in want[q]], abs=0.2)
        if q >= 1000:
            assert [i for i, _ in have[q]] == [i for i, _ in want[q]]


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert A.search(spark.createDataFrame([], schema)).count() == 0
    assert A.search(spark.createDataFrame([(50, [1.0, 2.0])], schema)).count() == 0
    three = spark.createDataFrame([(50, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)
    assert got(A.search(three)) == {50: [(1, pytest.approx(2 ** -0.5)), (2, 0.0)]}
    one_dim = spark.createDataFrame([(50, [1.0]), (1, [-1.0])], schema)
    assert got(A.search(one_dim)) == {50: [(1, -1.0)]}


def test_heap_visits_all_cells_in_order():
    rng = np.random.default_rng(0)
    b = A.Codebooks(rng.normal(size=(900, 6)))
    v = rng.normal(size=6)
    u = v / np.linalg.norm(v)
    d = [((u[:3] - b.halves[0][c // b.k]) ** 2).sum() + ((u[3:] - b.halves[1][c % b.k]) ** 2).sum()
         for c in b.visits(v)]
    assert len(d) == b.k ** 2 and all(x <= y + 1e-12 for x, y in zip(d, d[1:]))
