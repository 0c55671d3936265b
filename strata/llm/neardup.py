"""Near-duplicate groups by b-bit MinHash.

A document's set is its distinct ``n``-word shingles.  Documents with equal
sets form one class and travel as one node, named by a 128-bit digest.

1. ``BANDS`` keys of ``ROWS`` minima each find the nodes that may have a near
   duplicate at all: those that share a key with another node.
2. Only these get ``DEEP`` minima from their full sets.  Their low ``BITS``
   bits are the signature; the minima also make longer, more selective keys
   (``deep_rows``), which give the candidate pairs.
3. The share of equal bits, corrected for chance collisions, estimates a
   candidate pair's similarity; what passes with a margin is confirmed on the
   full sets.

No bucket is joined with itself.  First its members are compared with one
centre, and confirmed links merge components: that settles most buckets, as
further links within one component cannot change the result.  In a bucket
that still holds several components, members of different ones are compared
by their signatures inside tasks, in blocks of about ``BLOCK`` members, and
only what passes leaves the task, each pair from the first bucket it shares.
So each pair of a bucket is either compared or connected already; members,
partners and candidates have no cap.  A pair at the very threshold escapes
step 1 with probability (1 - t^ROWS)^BANDS (8e-7 at 0.85, 7e-5 at 0.8) and
step 2 with at most ``MISS``.

Cases: null, empty or wordless texts have an empty set (n_shingles 0), link
with nothing and are their own component; fewer words than ``n`` are one
shingle; rows with equal id and text are in one class and are all reported;
a null id never names a component unless nothing else is in it; other
columns are ignored by ``groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.llm.components import contract
from strata.llm.frames import Scratch, arrow_map, small, table

BANDS, ROWS = 24, 5
DEEP, BITS = 1920, 1
LONGS = DEEP * BITS // 64
MISS = 1e-4
MARGIN = 0.06      # about five standard errors of the estimate at 0.8 and more
BLOCK = 2048       # members compared at once
DEEP_BLOCK = 256   # rows whose DEEP minima are held at once

# odd factors and offsets of the permutations, on 32 bits of a shingle's hash
_AB = X.mix64(np.arange(1, 2 * DEEP + 1, dtype=X.U64) * X.U64(0x8CB92BA72F3D8DD7)) >> X.U64(32)
_A, _B = _AB[:DEEP].astype(np.uint32) | np.uint32(1), _AB[DEEP:].astype(np.uint32)


def deep_rows(percent: int) -> int:
    """Minima per key of step 2: as many as keep its loss under MISS."""
    t = percent / 100
    return max([r for r in range(1, 33) if (1 - t ** r) ** (DEEP // r) <= MISS], default=1)


# ---- sets and signatures -------------------------------------------------

def _sets(col: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct shingles row after row, how many in each row)."""
    for w in X.words(col):
        s, counts = X.shingles(w, n)
        ends = np.cumsum(counts)
        own = [np.unique(s[e - c:e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        yield w.first, (np.concatenate(own) if own else s), np.array([len(u) for u in own])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _minima(s: np.ndarray, first: np.ndarray, perms: int) -> np.ndarray:
    """Minima of the permutations for the (non-empty) rows beginning at ``first``."""
    x = (s >> X.U64(32)).astype(np.uint32)
    out = np.empty((perms, len(first)), np.uint32)
    for k in range(perms):
        out[k] = np.minimum.reduceat(x * _A[k] + _B[k], first)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """Low bits of the minima (mixed, so that small minima keep them), in longs."""
    out = np.zeros((LONGS, minima.shape[1]), X.U64)
    per = 64 // BITS
    for k in range(DEEP):
        low = X.mix64(minima[k].astype(X.U64) * X.FILL) & X.U64((1 << BITS) - 1)
        out[k // per] |= low << X.U64(BITS * (k % per))
    return out


def _keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for every ``rows`` minima, other for each band."""
    bands = len(minima) // rows
    out = np.empty((bands, minima.shape[1]), X.U64)
    for b in range(bands):
        key = np.full(minima.shape[1], b + 1, X.U64)
        for k in range(b * rows, (b + 1) * rows):
            key = X.mix64(key * X.FILL + minima[k])
        out[b] = key
    return out


def _fingerprint(n: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id")
        for row, s, counts in _sets(batch.column("text"), n):
            ends = np.cumsum(counts)
            has = np.flatnonzero(counts > 0)
            node = [_digest(s[e - c:e]) if c else None
                    for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            bands = np.zeros((len(counts), BANDS), np.int64)
            if len(has):
                bands[has] = _keys(_minima(s, (ends - counts)[has], BANDS * ROWS),
                                   ROWS).T.view(np.int64)
            yield pa.RecordBatch.from_arrays([
                ids.slice(row, len(counts)), pa.array(counts, pa.int64()),
                pa.array(node, pa.binary()), _lists(bands)],
                names=["doc_id", "n_shingles", "node", "bands"])
    return run


def _lists(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows).ravel()
    off = np.arange(0, flat.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def fingerprints(docs: DataFrame, n: int) -> DataFrame:
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprint(n),
                     "doc_id long, n_shingles long, node binary, bands array<long>")


def deep(docs: DataFrame, n: int, rows: int) -> DataFrame:
    """(node, set, sig, bands) of documents (text, node)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        want = batch.column("node").to_pylist()
        for row, s, counts in _sets(batch.column("text"), n):
            ends = np.cumsum(counts)
            # a row of the same id with another text is not the node's
            keep = [r for r, (e, c) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True))
                    if c and _digest(s[e - c:e]) == want[row + r]]
            # a block of rows at a time: DEEP minima of each are held at once
            for some in (keep[i:i + DEEP_BLOCK] for i in range(0, len(keep), DEEP_BLOCK)):
                own = np.concatenate([s[ends[r] - counts[r]:ends[r]] for r in some])
                off = np.concatenate([[0], np.cumsum(counts[some])])
                minima = _minima(own, off[:-1], DEEP)
                yield pa.RecordBatch.from_arrays([
                    pa.array([want[row + r] for r in some], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(own.view(np.int64))),
                    _lists(_packed(minima).T.view(np.int64)),
                    _lists(_keys(minima, rows).T.view(np.int64))],
                    names=["node", "set", "sig", "bands"])

    return arrow_map(docs, run, "node binary, set array<long>, sig array<long>, "
                     "bands array<long>")


# ---- similarity ----------------------------------------------------------

def estimate(a: str, b: str):
    """Similarity of two packed signatures, corrected for chance collisions."""
    fields = sum(1 << (BITS * k) for k in range(64 // BITS))
    fields -= (1 << 64) if fields >> 63 else 0
    differ = F.lit(0)
    for k in range(LONGS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        y = x
        for s in range(1, BITS):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(fields)))
    chance = 1.0 / (1 << BITS)
    return (1 - differ / DEEP - chance) / (1 - chance)


def _confirm(pairs: DataFrame, rows: int, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, la, lb) whose full sets are similar enough."""
    one = known.select(F.col("node").alias("a"), F.col("set").alias("xa"))
    two = known.select(F.col("node").alias("b"), F.col("set").alias("xb"))
    both = small(pairs, rows, 100).join(two, "b").join(one, "a").withColumn(
        "n", F.size(F.array_intersect("xa", "xb")))
    union = F.size("xa") + F.size("xb") - F.col("n")
    return both.filter(F.lit(100) * F.col("n") >= F.lit(percent) * union).select(*pairs.columns)


def _near(pairs: DataFrame, rows: int, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures may belong to similar enough sets."""
    one = known.select(F.col("node").alias("a"), F.col("sig").alias("xa"))
    two = known.select(F.col("node").alias("b"), F.col("sig").alias("xb"))
    return (small(pairs, rows, 100).join(two, "b").join(one, "a")
            .filter(estimate("xa", "xb") >= percent / 100 - MARGIN).select(*pairs.columns))


def _compare(percent: int):
    """Pairs of a block of a bucket that are in different components, may be
    similar enough, and share no earlier bucket."""
    cut = percent / 100 - MARGIN
    chance = 1.0 / (1 << BITS)
    most = DEEP * (1 - (cut * (1 - chance) + chance))  # differing fields

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        index, i, j = key[1].as_py(), key[2].as_py(), key[3].as_py()
        label = np.array(t["label"].to_pylist(), object)
        names, of, n = np.unique(label.astype("S"), return_inverse=True, return_counts=True)
        order = np.lexsort((of, n[of]))  # rows of small components first
        t, of = t.take(pa.array(order)), of[order]
        sig = _matrix(t["sig"])
        bands = _matrix(t["bands"])
        blk = t["blk"].to_numpy()
        out: list[tuple[int, int]] = []
        for x in range(len(of)):
            if of[x] == of[-1]:
                break  # the largest component is left, compared by all others
            y = x + 1 + np.flatnonzero(of[x + 1:] != of[x])
            if i != j:
                y = y[blk[y] != blk[x]]
            y = y[_differ(sig[x], sig[y]) <= most]
            y = y[(bands[y] == bands[x]).argmax(1) == index] if len(y) else y
            out += [(x, k) for k in y.tolist()]
        a, b = [pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)]
        return pa.table({"a": t["node"].take(a), "b": t["node"].take(b),
                         "la": t["label"].take(a), "lb": t["label"].take(b)})
    return run


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    flat = col.combine_chunks().flatten().to_numpy()
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def _differ(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Fields in which a signature differs from each of the others."""
    d = (rows ^ x).view(X.U64)
    y = d
    for s in range(1, BITS):
        y = y | (d >> X.U64(s))
    fields = X.U64(sum(1 << (BITS * k) for k in range(64 // BITS)))
    return np.bitwise_count(y & fields).sum(1, dtype=np.int64)


# ---- groups --------------------------------------------------------------

def _shared(members: DataFrame, scratch: Scratch) -> DataFrame:
    """The bands that hold at least two of the members."""
    return scratch.write(members.groupBy("band").agg(F.count("*").alias("m"))
                         .filter("m > 1").select("band"))


def _known(docs: DataFrame, classes: DataFrame, n: int, percent: int,
           scratch: Scratch) -> DataFrame:
    """Sets, signatures and keys of the nodes that share a band with another."""
    # the first half of the digest is enough here: a clash adds a node in vain
    nodes = classes.withColumn("nid", F.conv(F.substring(F.hex("node"), 1, 15), 16, 10).cast("long"))
    members = nodes.select("nid", F.explode("bands").alias("band"))
    some = members.join(_shared(members, scratch), "band").select("nid").distinct()
    some = scratch.write(nodes.join(some, "nid", "left_semi").select("node", "doc"))
    texts = docs.select(F.col("doc_id").cast("long").alias("of"), "text")
    mine = texts.join(small(some, some.count(), 40), F.col("of").eqNullSafe(F.col("doc")))
    known = scratch.write(deep(mine.select("text", "node"), n, deep_rows(percent)))
    again = known.groupBy("node").count().filter("count > 1")
    return known if again.isEmpty() else scratch.write(known.dropDuplicates(["node"]))


def _linked(docs: DataFrame, classes: DataFrame, n: int, percent: int,
            scratch: Scratch) -> DataFrame | None:
    """(node, label) of every node that shares a component with another one."""
    known = _known(docs, classes, n, percent, scratch)
    members = known.select("node", F.explode("bands").alias("band"))
    active = scratch.write(members.join(_shared(members, scratch), "band"))
    if active.isEmpty():
        return None
    # 1. every member with the bucket's centre
    heads = scratch.write(active.groupBy("band").agg(F.min("node").alias("a")))
    pairs = scratch.write(active.join(heads, "band").filter("node <> a").select(
        "a", F.col("node").alias("b"), F.col("a").alias("la"), F.col("node").alias("lb")).distinct())
    near = scratch.write(_near(pairs, pairs.count(), known, percent))
    links = scratch.write(_confirm(near, near.count(), known, percent).select("a", "b"))
    labels = contract(links, scratch)
    # 2. members of different components of a bucket, without its centre
    rest = scratch.write(
        active.join(heads.select("band", F.col("a").alias("node")), ["band", "node"], "left_anti")
        .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    unlike = scratch.write(rest.groupBy("band").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
        .filter("lo <> hi").select("band", F.ceil(F.col("m") / BLOCK).alias("blocks")))
    if unlike.isEmpty():
        return labels
    left = rest.join(unlike, "band").join(known.select("node", "sig", "bands"), "node")
    blk = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = (left.withColumn("blk", blk).withColumn("_j", other)
              .withColumn("_at", (F.array_position("bands", F.col("band")) - 1).cast("int"))
              .select("node", "label", "sig", "bands", "blk", "band", "_at",
                      F.least("blk", "_j").alias("_i"), F.greatest("blk", "_j").alias("_j")))
    again = scratch.write(placed.groupBy("band", "_at", "_i", "_j").applyInArrow(
        _compare(percent), "a binary, b binary, la binary, lb binary"))
    more = scratch.write(_confirm(again, again.count(), known, percent).select("a", "b"))
    if more.isEmpty():
        return labels
    return contract(links.unionByName(more), scratch)


def _grouped(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints (doc_id, n_shingles, node), and per class node: its
    smallest id, its component's smallest id, and its component's label."""
    scratch = Scratch(docs.sparkSession, "neardup")
    prints = scratch.write(fingerprints(docs, n))
    classes = scratch.write(
        prints.filter("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc"), F.first("bands").alias("bands")))
    labels = _linked(docs, classes, n, percent, scratch)
    own = classes.select("node", "doc")
    if labels is None:
        return prints, own.select("node", "doc", F.col("doc").alias("component_id"),
                                  F.col("node").alias("label"))
    own = scratch.write(own.join(labels, "node", "left")
                        .withColumn("label", F.coalesce("label", "node")))
    low = own.groupBy("label").agg(F.min("doc").alias("component_id"))
    return prints, own.join(scratch.write(low), "label").select(
        "node", "doc", "component_id", "label")


def groups(docs: DataFrame, n: int = 3, percent: int = 85) -> DataFrame:
    """Every document with its set size and component."""
    prints, classes = _grouped(docs, n, percent)
    return (prints.select("doc_id", "n_shingles", "node")
            .join(classes.select("node", "component_id"), "node", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    (F.col("doc_id") == F.col("component_id")).alias("kept")))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns: one of each near-duplicate group
    (the smallest id; of rows equal in id and set, any one), and every row
    without words."""
    _, classes = _grouped(docs, n, percent)
    # the class of each component's smallest id (nulls last; ties by node)
    best = classes.groupBy("label").agg(F.min(F.struct(
        F.col("doc").isNull(), "doc", "node")).alias("k")).select(F.col("k.node").alias("_node"))
    names = [f"_c{k}" for k in range(len(docs.columns))]  # clash with nothing
    plain = docs.toDF(*names)
    text, key = names[docs.columns.index("text")], names[docs.columns.index("doc_id")]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, s, counts in _sets(batch.column(text), n):
            ends = np.cumsum(counts)
            node = [_digest(s[e - c:e]) if c else None
                    for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            own = batch.slice(row, len(counts))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(node, pa.binary())], [*names, "_node"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    worded = F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    marked = arrow_map(plain.filter(worded), run, f"{schema}, _node binary")
    # one row per class first (cut in every task before the shuffle), then
    # the classes that stand for their component
    first = Window.partitionBy("_node").orderBy(F.col(key).asc_nulls_last())
    kept = (marked.withColumn("_r", F.row_number().over(first)).filter("_r = 1")
            .join(best, "_node", "left_semi").select(*names))
    return kept.unionByName(plain.filter(~worded)).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), 3, 85)
