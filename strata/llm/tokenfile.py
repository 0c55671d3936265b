"""Token ids of every document in bit-packed binary segments, and back.

A segment is a self-contained byte string (little-endian):

    4s  magic ``BPK1``          H  bits per id        H  flags (0)
    I   ids per block           Q  documents          Q  ids
    Q[documents + 1]            first id of each document, then the end
    Q[blocks]                   byte place of each block in the payload
    payload                     blocks of ids, ``bits`` bits each, low bit first

Every block starts on a byte, so a reader unpacks any id range from the
blocks that hold it, vectorised.  Segments are rows of a Parquet table in the
shared folder (Spark's writer commits them, so a lost executor or a repeated
task leaves no half file): shard, segment, document ids, payload.  Documents
ascend by id: rows are dealt into ranges by (doc_id, hash of the text), so
even one id on many rows is split, and shard numbers ascend with the ranges.

Texts are encoded once per distinct space-separated piece of a worker's
bounded cache; white space never takes part in a token of this vocabulary.

Cases: null text is empty (only the end id); a null doc_id comes first;
repeated rows and equal ids are written one after another; an empty table
writes no segment; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.llm.frames import Scratch, arrow_map, bound_batches, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
BLOCK = 4096             # ids per block
SEGMENT_IDS = 1 << 18    # ids after which a segment is closed
CACHE_PIECES = 1 << 20   # pieces a worker keeps, then it starts anew
JOINED = 500             # pieces that are encoded as one text
PIECE = X.byte_class((0x20, 0x20), (0x0A, 0x0A), invert=True)

MAGIC = b"BPK1"
HEAD = struct.Struct("<4sHHIQQ")

SEGMENTS = ("shard int, segment int, first_id long, n_docs long, n_ids long, "
            "doc_ids array<long>, data binary")
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


# ---- bit packing ---------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1,
                         bitorder="little")[:, :bits]
    return np.packbits(wide, bitorder="little").tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[:n * bits]
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = raw.reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def encode_segment(ids: np.ndarray, offsets: np.ndarray, bits: int) -> bytes:
    blocks = [pack(ids[i:i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    at = np.cumsum([0, *map(len, blocks)])[:-1] if blocks else np.zeros(0)
    return b"".join([HEAD.pack(MAGIC, bits, 0, BLOCK, len(offsets) - 1, len(ids)),
                     offsets.astype("<u8").tobytes(), at.astype("<u8").tobytes(), *blocks])


class Segment:
    """Reader of one segment; nothing is unpacked before it is asked for."""

    def __init__(self, data: bytes):
        magic, self.bits, _, self.block, self.n_docs, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a packed token segment")
        at = HEAD.size
        self.offsets = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        n_blocks = -(-self.n_ids // self.block)
        self.places = np.frombuffer(data, "<u8", n_blocks, at).astype(np.int64)
        self.payload = memoryview(data)[at + 8 * n_blocks:]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the segment, from their blocks alone."""
        out = []
        for b in range(start // self.block, -(-end // self.block)):
            n = min(self.block, self.n_ids - b * self.block)
            got = unpack(self.payload[self.places[b]:self.places[b] + -(-n * self.bits // 8)],
                         n, self.bits)
            out.append(got[max(start - b * self.block, 0):end - b * self.block])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.offsets[k]), int(self.offsets[k + 1]))


# ---- encoding ------------------------------------------------------------

class Encoder:
    """Ids of whole texts, each distinct piece encoded once while cached."""

    def __init__(self, path: str = TOKENIZER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.clear()

    def clear(self) -> None:
        self.keys = [np.zeros(0, X.U64), np.zeros(0, X.U64)]  # large, recent
        self.at = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.length = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash in the cache, -1 where it is new."""
        out = np.full(len(h), -1, np.int64)
        for keys, at in zip(self.keys, self.at, strict=True):
            if len(keys):
                k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                same = keys[k] == h
                out[same] = at[k[same]]
        return out

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without spaces, end to end, and their numbers.

        Many pieces go through the tokenizer as one text, with spaces between
        (no token holds or crosses white space); a token belongs to the piece
        in which it starts.
        """
        flat, length = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
        for i in range(0, len(pieces), JOINED):
            part = pieces[i:i + JOINED]
            got = self.tokenizer.encode_batch([" ".join(part)], add_special_tokens=False)[0]
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            start = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
            flat.append(np.array(got.ids, np.uint32))
            length.append(np.diff(np.searchsorted(start, ends), prepend=0).astype(np.int32))
        return np.concatenate(flat), np.concatenate(length)

    def _add(self, h: np.ndarray, pieces: list[str]) -> None:
        flat, length = self.encode(pieces)
        first = len(self.pool) + np.cumsum(length, dtype=np.int64) - length
        self.pool = np.concatenate([self.pool, flat])
        self.length = np.concatenate([self.length, length])
        self.first = np.concatenate([self.first, first])
        at = len(self.length) - len(h) + np.arange(len(h))
        keys, at = np.concatenate([self.keys[1], h]), np.concatenate([self.at[1], at])
        if len(keys) > max(1 << 14, len(self.keys[0]) // 4):
            keys, at = np.concatenate([self.keys[0], keys]), np.concatenate([self.at[0], at])
            order = np.argsort(keys)
            self.keys[0], self.at[0] = keys[order], at[order]
            self.keys[1], self.at[1] = np.zeros(0, X.U64), np.zeros(0, np.int64)
        else:
            order = np.argsort(keys)
            self.keys[1], self.at[1] = keys[order], at[order]

    def pieces(self, w: X.Words, which: np.ndarray | None = None) -> np.ndarray:
        """Cache place of each word of a slice (or of those given), after
        encoding the new ones."""
        h = w.hash if which is None else w.hash[which]
        uniq, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.length) + len(uniq) > CACHE_PIECES:
            self.clear()
        new = np.flatnonzero(self._find(uniq) < 0)
        if len(new):
            raw, at = w.buf.tobytes(), where[new] if which is None else which[where[new]]
            self._add(uniq[new], [raw[s:e].decode("utf-8") for s, e in
                                  zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)])
        return self._find(uniq)[inverse]

    def batches(self, col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, ids per row) of every slice of a column."""
        for w in X.words(col, PIECE, lower=False):
            at = self.pieces(w)
            n = self.length[at].astype(np.int64)
            ends = np.cumsum(n)
            flat = np.arange(ends[-1] if len(ends) else 0)
            flat += np.repeat(self.first[at] - (ends - n), n)
            cum = np.concatenate([[0], ends])[w.offsets]
            yield w.first, self.pool[flat], np.diff(cum)


@lru_cache(2)
def encoder(path: str = TOKENIZER) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ids followed by the end id."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


# ---- writing and reading -------------------------------------------------

def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
          segment_ids: int = SEGMENT_IDS) -> None:
    """Write the packed segments of ``docs`` (doc_id, text) as a table at ``path``."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    dealt = (docs.select(F.col("doc_id").cast("long"), "text",
                         F.xxhash64("text").alias("tie"))
             .repartitionByRange(shards, *keys).sortWithinPartitions(*keys, "text")
             .drop("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        bits, shard = bits_for(enc.vocabulary), TaskContext.get().partitionId()
        seg, first = 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lens))])
            data = encode_segment(np.concatenate(held), offsets, bits)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([seg], pa.int32()),
                pa.array([first], pa.int64()), pa.array([len(doc_ids)], pa.int64()),
                pa.array([size], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([data], pa.binary())],
                names=[c.split()[0] for c in SEGMENTS.split(", ")])

        for b in batches:
            own = b.column("doc_id").to_pylist()
            for row, ids, counts in enc.batches(b.column("text")):
                ids, counts = with_end(ids, counts, end_id)
                doc_ids += own[row:row + len(counts)]
                held.append(ids)
                lens.append(counts)
                size += len(ids)
                if size >= segment_ids:
                    yield close()
                    seg, first = seg + 1, first + size
                    doc_ids, held, lens, size = [], [], [], 0
        if doc_ids:
            yield close()

    bound_batches(spark)
    (dealt.mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a written table."""
    return spark.read.schema(SEGMENTS).parquet(path)


def digest(segments: DataFrame) -> DataFrame:
    """Place, length and crc32 of every document's ids, from the files."""
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, at = {}, 0
    for r in sizes:  # one row per shard
        starts[r["shard"]], at = at, at + r["n"]

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(b.num_rows):
            s = Segment(b.column("data")[k].as_py())
            base = starts[b.column("shard")[k].as_py()] + b.column("first_id")[k].as_py()
            ids = s.ids(0, s.n_ids)
            crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes())
                   for i, j in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_ids")[k].values, pa.array(base + s.offsets[:-1]),
                 pa.array(np.diff(s.offsets)), pa.array(crc, pa.int64())],
                names=[c.split()[0] for c in DIGEST.split(", ")])

    return arrow_map(segments.select("shard", "first_id", "doc_ids", "data"), run, DIGEST)


def encode(docs: DataFrame) -> DataFrame:
    """Write the documents' ids under the shared folder, read them back."""
    path = f"{Scratch(docs.sparkSession, 'tokens').root}/segments"
    write(docs, path)
    return digest(read(docs.sparkSession, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
