"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``n`` consecutive benchmark words (an item of
fewer words, but not none, is one shorter window).  Windows of one length are
searched together: a table indexed by the hash of a two-word block gives how
far the cursor may jump, positions whose block ends some window look up the
windows with that suffix, and these are compared word by word.  Many cursors,
one for each stretch of a text, move at once in numpy.

The benchmark is the stated query set: it is broadcast in blocks of at most
``BLOCK_BYTES`` of text, one pass over the documents for each block, so its
size has no limit and nothing of the documents is shuffled or collected.

Cases: null or wordless texts have no words and no hits; null or wordless
items have no windows; an item with a null id marks words but is not listed;
repeated rows are scanned each on its own; an empty benchmark hits nothing;
other columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import text as X
from strata.llm.frames import Scratch, arrow_map, table

WINDOW = 10
BLOCK_BYTES = 8 << 20
STRETCH = 256          # window ends per cursor
PAIRS = 1 << 18        # compared at once
TABLE_BITS = 20

REPORT = ("doc_id long, n_words long, n_hit long, n_items long, "
          "items_sha256 string, contaminated boolean")


class Group:
    """Windows of one length ``m`` over ``flat`` (word hashes of the block)."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, items: np.ndarray, m: int):
        self.m, self.b = m, min(2, m)
        key = np.zeros(len(starts), np.uint64)
        for k in range(m):
            key = X.mix64(key * X.FILL + flat[starts + k])
        # equal windows of several items are one pattern with several owners
        order = np.lexsort((items, key))
        key, starts, items = key[order], starts[order], items[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.at = starts[first]
        self.owner_off = np.concatenate([first, [len(key)]])
        self.owners = items
        suffix = self.block(flat, self.at + m - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.bucket = suffix[order], order
        self.shift = np.full(1 << TABLE_BITS, m - self.b + 1, np.uint8 if m < 255 else np.int64)
        for q in range(self.b, m + 1):
            slot = self.slot(self.block(flat, self.at + q - 1))
            self.shift[slot] = np.minimum(self.shift[slot], m - q)
        self.flat = flat

    def block(self, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the block of words that ends at ``last``."""
        x = h[last] * X.FILL
        if self.b == 2:
            x = x + h[last - 1]
        return X.mix64(x)

    @staticmethod
    def slot(block: np.ndarray) -> np.ndarray:
        return (block & X.U64((1 << TABLE_BITS) - 1)).astype(np.int64)

    def search(self, h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (last word, pattern) occurrences inside rows ``off``."""
        lo, hi = off[:-1] + self.m - 1, off[1:]
        rows = np.flatnonzero(lo < hi)
        if not len(rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = -(-(hi[rows] - lo[rows]) // STRETCH)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cur = np.repeat(lo[rows], n) + k * STRETCH
        stop = np.minimum(cur + STRETCH, np.repeat(hi[rows], n))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(cur):
            block = self.block(h, cur)
            jump = self.shift[self.slot(block)].astype(np.int64)
            hit = jump == 0
            if hit.any():
                found.extend(self.compare(h, cur[hit], block[hit]))
                jump[hit] = 1
            cur = cur + jump
            live = cur < stop
            cur, stop = cur[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def compare(self, h: np.ndarray, last: np.ndarray, block: np.ndarray
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a = np.searchsorted(self.suffix, block, side="left")
        n = np.searchsorted(self.suffix, block, side="right") - a
        keep = n > 0
        last, a, n = last[keep], a[keep], n[keep]
        cum = np.cumsum(n)
        i = 0
        while i < len(last):
            done = cum[i - 1] if i else 0
            j = max(int(np.searchsorted(cum, done + PAIRS, side="right")), i + 1)
            size = n[i:j]
            at = np.repeat(a[i:j] - (cum[i:j] - size - done), size) + np.arange(size.sum())
            pos, pat = np.repeat(last[i:j], size), self.bucket[at]
            for k in range(self.m):  # from the window's first word on
                same = h[pos - self.m + 1 + k] == self.flat[self.at[pat] + k]
                pos, pat = pos[same], pat[same]
                if not len(pos):
                    break
            if len(pos):
                yield pos, pat
            i = j


class Patterns:
    """Search structure of one benchmark block."""

    def __init__(self, texts: pa.Array, n: int):
        parts, items, counts = [], [], []
        for w in X.words(texts, X.ALNUM):
            parts.append(w.hash)
            items.append(w.first + np.arange(len(w.counts)))
            counts.append(w.counts)
        flat = np.concatenate(parts) if parts else np.zeros(0, X.U64)
        items = np.concatenate(items) if items else np.zeros(0, np.int64)
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        off = np.cumsum(counts) - counts
        self.groups = []
        size = np.minimum(counts, n)
        for m in np.unique(size[size > 0]):
            own = np.flatnonzero(size == m)
            many = counts[own] - m + 1
            starts = (np.repeat(off[own] - (np.cumsum(many) - many), many)
                      + np.arange(many.sum()))
            self.groups.append(Group(flat, starts, np.repeat(items[own], many), int(m)))

    def search(self, h: np.ndarray, off: np.ndarray):
        """Hit marks by word, and distinct (row, item) pairs."""
        edge = np.zeros(len(h) + 1, np.int64)
        pairs = []
        for g in self.groups:
            last, pat = g.search(h, off)
            np.add.at(edge, last - g.m + 1, 1)
            np.add.at(edge, last + 1, -1)
            row = np.searchsorted(off, last, side="right") - 1
            rp = np.unique(row * len(g.at) + pat) if len(row) else row
            row, pat = rp // max(len(g.at), 1), rp % max(len(g.at), 1)
            many = g.owner_off[pat + 1] - g.owner_off[pat]
            at = (np.repeat(g.owner_off[pat] - (np.cumsum(many) - many), many)
                  + np.arange(many.sum()))
            pairs.append(np.stack([np.repeat(row, many), g.owners[at]], 1))
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return np.cumsum(edge[:-1]) > 0, pairs


def _blocks(spark: SparkSession, benchmark: DataFrame) -> list[list]:
    """The benchmark as broadcasts of bounded size: (item ids as text, texts)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").filter(
        F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-total // BLOCK_BYTES), 1)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    out = []
    for k in range(n):
        t = items.filter(part == k).toArrow()
        out.append(spark.sparkContext.broadcast(
            (t["id"].to_pylist(), pa.array(t["text"].to_pylist(), pa.string()))))
    return out


_built: dict = {}


def _patterns(block, n: int) -> tuple[list, Patterns]:
    """The block's search structure, built once in each Python worker."""
    value = block.value
    if _built.get("of") is not value or _built.get("n") != n:
        _built.update(of=value, n=n, made=(value[0], Patterns(value[1], n)))
    return _built["made"]


def _scan(batch: pa.RecordBatch, block, n: int):
    """Word counts, hit marks by word and item ids by row, joined with those
    of earlier blocks if the batch carries them."""
    ids, patterns = _patterns(block, n)
    rows = batch.num_rows
    before = "_marks" in batch.schema.names
    marks: list[np.ndarray] = [np.zeros(0, bool)] * rows
    items: list[set] = [set() for _ in range(rows)]
    for w in X.words(batch.column("text"), X.ALNUM):
        off = w.offsets
        hit, pairs = patterns.search(w.hash, off)
        for r in range(len(w.counts)):
            marks[w.first + r] = hit[off[r]:off[r + 1]]
        for r, item in pairs.tolist():
            if ids[item] is not None:
                items[w.first + r].add(ids[item])
    if before:
        for r in range(rows):
            old = np.frombuffer(batch.column("_marks")[r].as_py(), bool)
            marks[r] = marks[r] | old
            items[r] |= set(batch.column("_items")[r].as_py())
    return marks, items


def _passes(docs: DataFrame, blocks: list, n: int) -> tuple[DataFrame, list]:
    """All blocks but the last, one written pass each; the last one's block.
    One block, the usual case, needs no pass."""
    schema = T.StructType([*docs.schema, T.StructField("_marks", T.BinaryType()),
                           T.StructField("_items", T.ArrayType(T.StringType()))])
    scratch = Scratch(docs.sparkSession, "decontaminate")
    for k, block in enumerate(blocks[:-1]):
        def run(b: pa.RecordBatch, block=block) -> Iterator[pa.RecordBatch]:
            marks, items = _scan(b, block, n)
            own = [c for c in b.schema.names if c not in ("_marks", "_items")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in own), pa.array([m.tobytes() for m in marks], pa.binary()),
                 pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
                [*own, "_marks", "_items"])

        done = scratch.write(arrow_map(docs, run, schema))
        if k:
            scratch.drop(docs)
        docs = done
    return docs, blocks[-1]


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per document with its hit words and the items that hit it."""
    docs = docs.select("doc_id", "text")
    docs, block = _passes(docs, _blocks(docs.sparkSession, benchmark), n)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks, items = _scan(b, block, n)
        n_hit = [int(m.sum()) for m in marks]
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array([len(m) for m in marks], pa.int64()),
            pa.array(n_hit, pa.int64()), pa.array([len(i) for i in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]),
            pa.array([h > 0 for h in n_hit])], names=[c.split()[0] for c in REPORT.split(", ")])

    return arrow_map(docs, run, REPORT)


def clean(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark window hits."""
    schema = docs.schema
    docs, block = _passes(docs, _blocks(docs.sparkSession, benchmark), n)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks, _ = _scan(b, block, n)
        yield b.filter(pa.array([not m.any() for m in marks])).select(schema.names)

    return arrow_map(docs, run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
