"""Passages that repeat across documents, by a sparse suffix array.

Words are compared, not characters.  Only suffixes that begin at content-
selected places are retained: a place is a minimiser if its ``GRAM`` words
have the smallest hash of some ``SPREAD`` consecutive places.  Every passage of
``MIN_WORDS`` words therefore holds, within its first ``SPREAD`` places, a
retained suffix that is retained in each copy of the passage too.

1. The retained suffixes are dealt into ranges and sorted by the digest of
   their first ``HEAD`` words and by document, and neighbours are compared: a
   run of equal beginnings with two documents in it survives.
2. Around each survivor the match is extended left and right: every passage
   of ``MIN_WORDS`` words that begins up to ``SPREAD - 1`` words before it is
   sorted and compared with its neighbours in the same way.
3. What passes is merged into maximal spans.

A word is thus in a span exactly if it lies in ``MIN_WORDS`` consecutive words
that also occur in a document of another id.  A document sends each digest
once, however often it repeats it, and rows are dealt by (digest, document),
so a passage that many documents share is spread over many tasks.

Cases: null, empty and short texts have no spans; rows of one id are one
document, so copies within it do not count, and their spans are reported
together; rows with null id count as one document with a null id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.llm.frames import Scratch, arrow_map, table

MIN_WORDS = 50
GRAM = 8
SPREAD = 16                     # a power of two
HEAD = MIN_WORDS - SPREAD + 1   # words of a passage from its retained suffix on
NO_ID = -(1 << 63)

SPANS = "doc_id long, start long, end long, n_words long"


def _sliding(x: np.ndarray, best) -> np.ndarray:
    """``best`` of every SPREAD consecutive values, by doubling."""
    s = 1
    while s < SPREAD:
        x = best(x[:-s], x[s:])
        s *= 2
    return x


def _digests(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Digest of the ``n`` words from each place on."""
    acc = np.zeros(len(at), X.U64)
    for k in range(n):
        acc += h[at + k] * X._MULT[k]
    return X.mix64(acc)


def retained(w: X.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (and rows) of the retained suffixes with HEAD words left."""
    none = np.zeros(0, np.int64)
    off, n = w.offsets, len(w.hash)
    if n < MIN_WORDS:
        return none, none
    row = np.repeat(np.arange(len(w.counts)), w.counts)
    end = off[1:][row]
    g = X.window_hashes(w.hash, GRAM)
    at = np.arange(len(g))
    inside = at + GRAM <= end[:len(g)]
    if len(g) < SPREAD:
        return none, none
    low = _sliding(np.where(inside, g, ~X.U64(0)), np.minimum)
    whole = at[:len(low)] + GRAM + SPREAD - 1 <= end[:len(low)]
    low = np.where(whole, low, X.U64(0))  # windows across a border choose nothing
    edge = np.zeros(SPREAD - 1, X.U64)
    top = _sliding(np.concatenate([edge, low, edge]), np.maximum)
    at = np.flatnonzero((g == top) & inside & (at + HEAD <= end[:len(g)]))
    return at, row[at]


def _suffixes(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = b.column("doc").to_numpy()
    for w in X.words(b.column("text")):
        at, row = retained(w)
        key = _digests(w.hash, at, HEAD)
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[new].view(np.int64)), pa.array(ids[w.first + row[new]])],
            names=["key", "doc"])


def _passages(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Passages around the surviving suffixes of each document."""
    ids, keys = b.column("doc").to_numpy(), b.column("keys")
    for w in X.words(b.column("text")):
        at, row = retained(w)
        mine = _digests(w.hash, at, HEAD).view(np.int64)
        off = w.offsets
        cut = np.searchsorted(row, np.arange(len(w.counts) + 1))
        for r in np.flatnonzero(np.diff(cut)):
            a, e = cut[r], cut[r + 1]
            p = at[a:e][np.isin(mine[a:e], keys[w.first + int(r)].values.to_numpy())]
            starts = np.unique((p[:, None] - np.arange(SPREAD)).ravel())
            starts = starts[(starts >= off[r]) & (starts + MIN_WORDS <= off[r + 1])]
            if not len(starts):
                continue
            key = _digests(w.hash, starts, MIN_WORDS)
            order = np.argsort(key, kind="stable")
            key, starts = key[order], (starts[order] - off[r]).astype("<i4")
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.append(first[1:], len(key)) * 4
            raw = starts.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[first].view(np.int64)), pa.array(np.full(len(first), ids[w.first + r])),
                 pa.BinaryArray.from_buffers(
                     pa.binary(), len(first),
                     [None, pa.py_buffer(np.append(first * 4, ends[-1:]).astype(np.int32)),
                      pa.py_buffer(raw)])], names=["key", "doc", "starts"])


def _neighbours(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose key is shared by two documents, from sorted rows.  Runs at
    the edge of a batch may go on elsewhere and stay open."""
    key, doc = b.column("key").to_numpy(), b.column("doc").to_numpy()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(key)) - 1
    shared = doc[first] != doc[last]
    open_ = np.zeros(len(first), bool)
    open_[[0, -1]] = True
    n = last - first + 1
    keep = np.repeat(shared | open_, n)
    out = b.filter(pa.array(keep))
    yield pa.RecordBatch.from_arrays(
        [*out.columns, pa.array(np.repeat(open_, n)[keep])], [*out.schema.names, "open"])


def _across(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows (key, doc, ...) whose key occurs with at least two documents."""
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(shards, "key", "doc").sortWithinPartitions("key", "doc")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    seen = scratch.write(arrow_map(dealt, _neighbours, f"{schema}, open boolean"))
    open_ = seen.filter("open")
    shared = scratch.write(open_.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                           .filter("lo <> hi").select("key"))
    return seen.filter("not open").unionByName(open_.join(shared, "key", "left_semi")).drop("open")


def _merge(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Maximal spans of each document from the starts of its passages."""
    out: list[list[np.ndarray]] = [[], [], []]
    for doc, parts in zip(b.column("doc").to_pylist(), b.column("starts").to_pylist(), strict=True):
        s = np.unique(np.frombuffer(b"".join(parts), "<i4")).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], s[1:] > s[:-1] + MIN_WORDS]))
        out[0].append(np.full(len(first), doc))
        out[1].append(s[first])
        out[2].append(s[np.append(first[1:], len(s)) - 1] + MIN_WORDS)
    doc, start, end = (np.concatenate(x) for x in out)
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64(), mask=doc == NO_ID), pa.array(start), pa.array(end),
         pa.array(end - start)], names=[c.split()[0] for c in SPANS.split(", ")])


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, n_words) of every repeated passage, in words."""
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    same = _across(arrow_map(texts, _suffixes, "key long, doc long"), scratch)
    wanted = scratch.write(same.groupBy("doc").agg(F.collect_set("key").alias("keys")))
    again = texts.join(wanted, "doc").select("doc", "text", "keys")
    found = _across(arrow_map(again, _passages, "key long, doc long, starts binary"), scratch)
    return arrow_map(found.groupBy("doc").agg(F.collect_list("starts").alias("starts")), _merge, SPANS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "documents"))
