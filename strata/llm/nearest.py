"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut in two halves; each half has a codebook of its own, and a
vector's cell is its pair of nearest centroids.  A query visits cells in
ascending order of the two halves' summed distance, taken from a heap over
the sorted centroid lists, until the cells seen hold the search depth of
entries; what lies in them is reranked by exact cosine in double precision.

Fitted on bounded samples: the codebooks on about ``FIT_VECTORS`` vectors
chosen by hash, and the depth on about ``FIT_QUERIES`` queries, whose true
neighbours over all rows tell how deep the traversal must go to reach
``RECALL`` (so data without structure are searched deeply and clustered data
shallowly).  Every vector is indexed and no cell is capped.

Equal vectors are one entry with their ``TOP + 1`` smallest ids, which is all
a query can need, so a vector that a third of all rows share costs one entry.
Entries and queries are dealt into blocks of bounded size by cell (larger
cells are split by hash), and only blocks that meet are brought together.

Cases: vectors null, zero, or holding null or non-finite components, of
another length than most, or with a null id take no part; equal rows count
once; an id on several different vectors is searched as each of them; with
fewer candidates all are returned; ties go to the smaller id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, arrow_map, table

TOP = 5
FIT_VECTORS, FIT_QUERIES, FIT_ROUNDS = 20_000, 64, 8
CENTROIDS = 64            # per half at most
RECALL = 0.97             # aimed at by the depth; 0.9 is promised
ENTRY_BLOCK, QUERY_BLOCK = 2048, 512
EVERY = 50                # queries: ids divisible by this

FOUND = "query_id long, rank int, vec_id long, score double"


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as a matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.ascontiguousarray(flat.reshape(len(col), -1))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products; each pair is summed in one order, whatever the block."""
    return np.einsum("id,jd->ij", a, b)


def norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("id,id->i", a, a))


# ---- index ---------------------------------------------------------------

def entries(vectors: DataFrame) -> DataFrame:
    """(cid, v, ids): one row per distinct valid vector."""
    v = F.col("embedding").cast("array<double>")
    ok = (F.col("vec_id").isNotNull() & v.isNotNull()
          & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
          & F.exists(v, lambda x: x != 0.0))
    valid = vectors.filter(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long"), v.alias("v"))
    length = valid.groupBy(F.size("v").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).limit(1).select("d").collect()
    valid = valid.filter(F.size("v") == (length[0]["d"] if length else 0))
    cid = F.concat_ws(":", F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.reverse("v"))))
    return valid.select(cid.alias("cid"), "vec_id", "v").dropDuplicates(["cid", "vec_id"])


def distinct_vectors(rows: DataFrame) -> DataFrame:
    first = Window.partitionBy("cid").orderBy("vec_id")
    return (rows.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= TOP + 1)
            .groupBy("cid").agg(F.first("v").alias("v"),
                                F.sort_array(F.collect_list("vec_id")).alias("ids")))


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Plain k-means from evenly spread starts (rows come in hash order)."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        a = nearest(x, c)
        n = np.bincount(a, minlength=k)
        s = np.zeros(c.shape)
        for d in range(x.shape[1]):
            s[:, d] = np.bincount(a, x[:, d], k)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (2 * (x @ c.T) - (c * c).sum(1)).argmax(1)


class Codebooks:
    def __init__(self, x: np.ndarray):
        u = x / norms(x)[:, None]
        self.cut = max(u.shape[1] // 2, 1)
        self.k = max(1, min(CENTROIDS, int((len(x) / 8) ** 0.5)))
        self.halves = [kmeans(u[:, :self.cut], self.k), kmeans(u[:, self.cut:], self.k)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        u = x / norms(x)[:, None]
        return (nearest(u[:, :self.cut], self.halves[0]) * self.k
                + nearest(u[:, self.cut:], self.halves[1]))

    def visits(self, v: np.ndarray) -> Iterator[int]:
        """Cells in ascending order of summed distance to one vector."""
        u = v / np.sqrt((v * v).sum())
        d = [((u[a:b] - c) ** 2).sum(1) for (a, b), c in
             zip(((0, self.cut), (self.cut, len(u))), self.halves, strict=True)]
        o = [np.argsort(x, kind="stable").tolist() for x in d]
        d = [[float(x[i]) for i in order] for x, order in zip(d, o, strict=True)]
        heap = [(d[0][0] + d[1][0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield o[0][i] * self.k + o[1][j]
            if i + 1 < self.k and j == 0:  # each pair has one way in
                heapq.heappush(heap, (d[0][i + 1] + d[1][0], i + 1, 0))
            if j + 1 < self.k:
                heapq.heappush(heap, (d[0][i] + d[1][j + 1], i, j + 1))


def visited(books: Codebooks, v: np.ndarray, counts: np.ndarray, depth: int) -> list[int]:
    """The non-empty cells that a query visits down to ``depth`` entries."""
    out, seen = [], 0
    for cell in books.visits(v):
        if counts[cell]:
            out.append(cell)
            seen += int(counts[cell])
            if seen >= depth:
                break
    return out


def _sample(df: DataFrame, n: int, total: int) -> DataFrame:
    unit = F.pmod(F.xxhash64("cid", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return df.filter(unit < n / max(total, 1))


def _best(index: DataFrame, queries: list, own: bool) -> DataFrame:
    """Exact nearest entries of a bounded list of (cid, vector), over all."""
    cids, q = [c for c, _ in queries], np.array([v for _, v in queries])

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = matrix(b.column("v"))
        s = dots(q, x) / (norms(q)[:, None] * norms(x))
        there = b.column("cid").to_pylist()
        at = {c: i for i, c in enumerate(there)}
        for i, c in enumerate(cids):
            if not own and c in at:
                s[i, at[c]] = -2
        keep = np.argsort(-s, axis=1)[:, :TOP]
        cell = b.column("cell").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(q)), keep.shape[1])), pa.array(cell[keep].ravel()),
             pa.array(np.take_along_axis(s, keep, 1).ravel())], names=["q", "cell", "score"])

    order = Window.partitionBy("q").orderBy(F.desc("score"))
    return (arrow_map(index.select("cid", "v", "cell"), run, "q long, cell long, score double")
            .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= TOP))


def fit_depth(books: Codebooks, counts: np.ndarray, index: DataFrame, sample: list) -> int:
    """Entries to look at so that RECALL of the sample's true neighbours is met."""
    need = []
    for q, cell in [(r["q"], r["cell"]) for r in _best(index, sample, own=False).collect()
                    if r["score"] > -2]:
        seen = 0
        for c in books.visits(np.array(sample[q][1])):
            seen += int(counts[c])
            if c == cell:
                break
        need.append(seen)
    return int(np.quantile(need, RECALL, method="higher")) if need else 1


# ---- search --------------------------------------------------------------

def pack(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell: neighbouring cells
    share a block up to ``size`` rows, a larger cell has blocks of its own."""
    first, many = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, held = 0, 0
    for c, n in enumerate(counts.tolist()):
        if held and held + n > size:
            block, held = block + 1, 0
        first[c], many[c] = block, max(1, -(-n // size))
        held += n
        if many[c] > 1:
            block, held = block + int(many[c]), 0
    return first, many


def _with_block(df: DataFrame, places: tuple[np.ndarray, np.ndarray], name: str) -> DataFrame:
    """The block of each row by its cell; the table of cells is bounded by the
    codebooks (CENTROIDS squared)."""
    first, many = places
    small = df.sparkSession.createDataFrame(
        [(c, f, m) for c, (f, m) in enumerate(zip(first.tolist(), many.tolist(), strict=True))],
        "cell long, _f long, _m long")
    return (df.join(F.broadcast(small), "cell")
            .withColumn(name, F.col("_f") + F.pmod(F.xxhash64("cid"), F.col("_m")))
            .drop("_f", "_m"))


def _counted(df: DataFrame, cells: int) -> np.ndarray:
    counts = np.zeros(cells, np.int64)
    for r in df.groupBy("cell").count().collect():  # at most one row per cell
        counts[r["cell"]] = r["count"]
    return counts


def _rerank(key, queries: pa.Table, members: pa.Table) -> pa.Table:
    """Nearest entries of each query among its visited cells of a block."""
    if not queries.num_rows or not members.num_rows:
        return pa.table({"cid": pa.array([], pa.string()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.float64())})
    x = matrix(members["v"])
    cell = members["cell"].to_numpy()
    order = np.argsort(cell, kind="stable")
    x, cell = x[order], cell[order]
    ids = members["ids"].combine_chunks().take(pa.array(order))
    low = np.array([i[0] for i in ids.to_pylist()])
    q = matrix(queries["v"])
    nx, nq = norms(x), norms(q)
    visits = queries["cells"].combine_chunks()
    of = np.repeat(np.arange(len(q)), np.diff(visits.offsets.to_numpy()))
    flat = visits.flatten().to_numpy()
    by = np.argsort(flat, kind="stable")
    of, flat = of[by], flat[by]
    best: list[list[tuple[float, int, int]]] = [[] for _ in range(len(q))]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else []
    ends = np.append(starts[1:], len(flat)) if len(flat) else []
    for s, e in zip(starts, ends, strict=True):
        a, b = np.searchsorted(cell, [flat[s], flat[s] + 1])
        if a == b:
            continue
        score = dots(q[of[s:e]], x[a:b]) / (nq[of[s:e], None] * nx[a:b])
        if b - a > TOP + 1:  # entries below the best few cannot matter, ties stay
            bar = np.partition(score, -(TOP + 1), axis=1)[:, -(TOP + 1)]
        else:
            bar = np.full(e - s, -np.inf)
        for i, k in np.argwhere(score >= bar[:, None]).tolist():
            best[of[s + i]].append((-score[i, k], int(low[a + k]), a + k))
    out = ([], [], [])
    names = queries["cid"].to_pylist()
    lists = ids.to_pylist()
    for i, found in enumerate(best):
        top = [(s, v) for s, _, k in heapq.nsmallest(TOP + 1, found) for v in lists[k]]
        for s, v in heapq.nsmallest(TOP + 1, top):
            out[0].append(names[i])
            out[1].append(v)
            out[2].append(-s)
    return pa.table({"cid": pa.array(out[0], pa.string()), "vec_id": pa.array(out[1], pa.int64()),
                     "score": pa.array(out[2], pa.float64())})


def search(vectors: DataFrame, is_query=None) -> DataFrame:
    """The TOP nearest rows of every query row (by default ids divisible by
    EVERY) among all other rows."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    rows = scratch.write(entries(vectors))
    wanted = rows.filter(is_query if is_query is not None else F.col("vec_id") % EVERY == 0)
    distinct = scratch.write(distinct_vectors(rows))
    total = distinct.count()
    n_queries = wanted.count()
    if total == 0 or n_queries == 0:
        return spark.createDataFrame([], FOUND)
    fit = _sample(distinct, FIT_VECTORS, total).orderBy("cid").select("v").toArrow()
    if not fit.num_rows:
        fit = distinct.limit(1).select("v").toArrow()
    books = Codebooks(matrix(fit["v"]))

    def assign(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cell = books.cells(matrix(b.column("v")))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*b.schema.names, "cell"])

    index = scratch.write(arrow_map(distinct, assign,
                                    "cid string, v array<double>, ids array<long>, cell long"))
    cells = books.k ** 2
    counts = _counted(index, cells)
    asked = scratch.write(index.join(wanted.select("cid").distinct(), "cid", "left_semi")
                          .select("cid", "v", "cell"))
    q_counts = _counted(asked, cells)
    sample = [(r["cid"], r["v"]) for r in
              _sample(asked, FIT_QUERIES, int(q_counts.sum())).orderBy("cid").collect()]
    depth = max(fit_depth(books, counts, index, sample) if sample else int(counts.sum()), TOP + 1)
    first, many = pack(counts, ENTRY_BLOCK)

    def probe(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = matrix(b.column("v"))
        of, block, lists = [], [], []
        for i in range(len(x)):
            own: dict[int, list[int]] = {}
            for c in visited(books, x[i], counts, depth):
                for m in range(first[c], first[c] + many[c]):
                    own.setdefault(int(m), []).append(c)
            of += [i] * len(own)
            block += own
            lists += own.values()
        part = b.take(pa.array(of, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [part.column("qb"), pa.array(block, pa.int64()), part.column("cid"), part.column("v"),
             pa.array(lists, pa.list_(pa.int64()))], names=["qb", "mb", "cid", "v", "cells"])

    probes = scratch.write(arrow_map(
        _with_block(asked, pack(q_counts, QUERY_BLOCK), "qb").select("cid", "v", "qb"), probe,
        "qb long, mb long, cid string, v array<double>, cells array<long>"))
    meet = probes.select(F.col("qb").alias("gq"), F.col("mb").alias("gm")).distinct()
    placed = _with_block(index, (first, many), "gm")
    members = placed.join(meet, "gm").select("gq", "gm", "cid", "v", "ids", "cell")
    found = (probes.groupBy("qb", "mb").cogroup(members.groupBy("gq", "gm"))
             .applyInArrow(_rerank, "cid string, vec_id long, score double"))
    order = Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id")
    best = (found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= TOP + 1)
            .groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score")))
                                .alias("best")))
    mine = wanted.select(F.col("vec_id").alias("query_id"), "cid").join(
        scratch.write(best), "cid")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, TOP)
    return mine.select("query_id", F.posexplode(others).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
