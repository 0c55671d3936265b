"""Alignment of two tokenizers over every whole text, as an Arrow pipeline.

Tokens of A (byte-level BPE over space + text) and of B (sentence pieces, which
add that space) are byte ranges of one string.  Of a batch of documents:

1. the token lists are flattened; parent indices say whose token each one is;
2. token lengths from the vocabulary, summed up within each document, give the
   end of every token; (document, end) is one 64-bit key;
3. an Acero full outer join on these keys gives every place where a token of A
   or of B ends.  Sorted, each place closes one atomic range, which lies in
   exactly one token of A and one of B: a link.  Places where both end cut the
   tokens into groups;
4. ``Table.group_by`` reduces links to the id pairs of a document and, over the
   written rows, to partial document counts, which Spark adds up.

Neither vocabulary has a token that runs from a character other than white
space into a space, so both tokenizations restart there: texts are cut into
units at such places, and a unit is encoded once while a worker's bounded cache
holds it.  Slices of about ``SLICE`` bytes end at such places too, so memory
follows the slice, not the text.

Corpus-wide counts go back to the documents in two ways.  Pairs of the most
documents, at most ``FREQUENT`` of them, are broadcast; all others, each in few
documents, are joined by Spark on the pair.

Cases: texts that are null, empty, or not given back byte by byte by either
tokenizer (a literal U+2581, say) have no tokens: zeros and an empty digest.
Null or repeated ids and repeated rows are rows, and documents, of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, arrow_map, bound_batches, table
from strata.llm.text import utf8

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
PART = 4 << 20           # bytes of text whose units are looked up together
SLICE = 1 << 20          # bytes of text that go through the joins together
CACHE_UNITS = 1 << 20    # units a worker keeps, then it starts anew
FREQUENT = 1 << 20       # pairs that are broadcast at most (17 bytes each)

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, pairs array<long>, times array<int>")
PAIR = np.int64(1) << 32  # a pair of ids is one number: a * PAIR + b


# ---- the tokenizers --------------------------------------------------------

def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: printable ones of
    Latin-1 as themselves, the rest in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes of a byte-level tokenizer; units keep their space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        letters = _byte_of_letter()
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(letters[c] for c in token)

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class Pieces:
    """Ids and token bytes of a sentence-piece model, which adds the space that
    every unit begins with."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes.append(b"")  # never equals the text
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
        self.space = self.model.piece_to_id("▁")

    def encode(self, units: list[str]) -> list[list[int]]:
        got = self.model.encode([u[1:] for u in units], num_threads=1)
        return [ids if u != " " else [self.space] for u, ids in zip(units, got, strict=True)]


class Units:
    """Token lists of units, each encoded once while it is kept."""

    def __init__(self, path_a: str, path_b: str):
        self.coders = (ByteLevel(path_a), Pieces(path_b))
        self.lengths = [pa.array([len(b) for b in c.bytes], pa.int32()) for c in self.coders]
        self.names = [pa.array([str(i) for i in range(len(c.bytes))]) for c in self.coders]
        self.bytes = [pa.array(c.bytes, pa.binary()) for c in self.coders]
        self.clear()

    def clear(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.lists = [pa.array([], pa.list_(pa.int32())) for _ in self.coders]
        self.exact = pa.array([], pa.bool_())

    def find(self, distinct: pa.Array) -> pa.Array:
        """Place of each unit, after encoding the new ones."""
        if len(self.keys) + len(distinct) > CACHE_UNITS:
            self.clear()
        at = pc.index_in(distinct, self.keys)
        new = distinct.filter(pc.is_null(at))
        if not len(new):
            return at
        place = at.fill_null(-1).to_numpy().copy()
        place[place < 0] = len(self.keys) + np.arange(len(new))
        units, said, exact = new.to_pylist(), new.cast(pa.large_binary()), None
        for k, c in enumerate(self.coders):
            lists = pa.array(c.encode(units), pa.list_(pa.int32()))
            tokens = pa.ListArray.from_arrays(lists.offsets, pc.take(self.bytes[k], lists.values))
            same = pc.equal(pc.binary_join(tokens, b""), said)
            exact = same if exact is None else pc.and_(exact, same)
            self.lists[k] = pa.concat_arrays([self.lists[k], lists])
        self.keys = pa.concat_arrays([self.keys, new])
        self.exact = pa.concat_arrays([self.exact, exact])
        return pa.array(place)


@lru_cache(1)
def units_of(path_a: str, path_b: str) -> Units:
    return Units(path_a, path_b)


# ---- cutting texts into units ----------------------------------------------

def unit_starts(buf: np.ndarray) -> np.ndarray:
    """Places where a space follows a character that is surely no white space:
    printable ASCII, or a two-byte letter from U+00C0 on."""
    at = np.flatnonzero(buf[1:] == 0x20) + 1
    before = buf[at - 1]
    plain = (before > 0x20) & (before < 0x7F)
    lead = buf[np.maximum(at - 2, 0)]
    letter = (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0) & (at >= 2)
    return at[plain | letter]


def _parts(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes with the leading spaces, row bounds) of about ``PART``
    bytes; a longer text comes alone, in pieces cut at unit starts."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + PART, side="right")) - 1)
        bounds = off[i:j + 1] - off[i]
        buf = np.insert(data[off[i]:off[j]], bounds[:-1], 0x20)
        bounds = bounds + np.arange(j - i + 1)
        if j - i == 1 and len(buf) > PART:
            cuts, a = unit_starts(buf), 0
            while a < len(buf):
                k = int(np.searchsorted(cuts, a + PART))
                b = int(cuts[k]) if k < len(cuts) else len(buf)
                yield i, buf[a:b], np.array([0, b - a])
                a = b
        else:
            yield i, buf, bounds
        i = j


def _cut(buf: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The units of a part as strings, the row of each and its bytes."""
    first = np.zeros(len(buf), bool)
    first[unit_starts(buf)] = True
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    offsets = np.append(np.flatnonzero(first), len(buf))
    units = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf)))
    return units, np.searchsorted(bounds, offsets[:-1], side="right") - 1, np.diff(offsets)


# ---- the alignment of a slice ----------------------------------------------

def _tokens(lists: pa.Array, rows: np.ndarray, lengths: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Ids of all tokens, and the (row, end) key of each: ends are sums of
    lengths within the row."""
    ids = pc.list_flatten(lists)
    row = rows[pc.list_parent_indices(lists).to_numpy()]
    sums = np.concatenate([[0], pc.cumulative_sum(pc.cast(pc.take(lengths, ids), pa.int64())).to_numpy()])
    first = np.searchsorted(row, np.arange(row[-1] + 1 if len(row) else 0))
    return ids, pa.array((row << 32) | (sums[1:] - sums[first][row]))


def _joined(names: pa.Array, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), pc.take(names, ids))
    return pc.binary_join(lists.cast(pa.list_(pa.string())), ",")


def align_slice(units: Units, at: pa.Array, rows: np.ndarray):
    """Of units, by their places and rows (from 0, ascending): per row n_a, n_b,
    groups and links; per row the text of its groups; the links as a sorted
    table (row, pair, times)."""
    n_rows = int(rows[-1]) + 1
    sides = [_tokens(pc.take(units.lists[k], at), rows, units.lengths[k]) for k in (0, 1)]
    (a, _), (b, _) = sides
    n = [np.bincount(end.to_numpy() >> 32, minlength=n_rows) for _, end in sides]
    tables = [pa.table({"end": end, f"has_{k}": pa.array(np.ones(len(end), bool))})
              for k, (_, end) in enumerate(sides)]
    ends = tables[0].join(tables[1], "end", join_type="full outer", use_threads=False)
    ends = ends.take(pc.sort_indices(ends["end"])).combine_chunks()
    place = ends["end"].to_numpy()
    has = [ends[f"has_{k}"].is_valid().to_numpy() for k in (0, 1)]
    # a place lies in the token whose end is the next one of its side
    token = [np.cumsum(h) - h for h in has]
    row = place >> 32
    pair = pc.take(a, pa.array(token[0])).to_numpy().astype(np.int64) * PAIR \
        + pc.take(b, pa.array(token[1])).to_numpy()
    links = pa.table({"row": row, "pair": pair}).group_by(
        ["row", "pair"], use_threads=False).aggregate([([], "count_all")])
    links = links.take(pc.sort_indices(links, [("row", "ascending"), ("pair", "ascending")])) \
        .rename_columns(["row", "pair", "times"])

    both = has[0] & has[1]  # group ends
    cut = [np.concatenate([[0], token[k][both] + 1]) for k in (0, 1)]
    said = pc.binary_join_element_wise(_joined(units.names[0], a, cut[0]),
                                       _joined(units.names[1], b, cut[1]), "|")
    groups = np.bincount(row[both], minlength=n_rows)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(groups)])), said)
    texts = pc.binary_join(lists.cast(pa.list_(pa.string())), ";")
    return np.array([*n, groups, np.bincount(row, minlength=n_rows)]), texts, links


# ---- passes over the documents ---------------------------------------------

class _Row:
    """What the slices of one document add up to."""

    def __init__(self) -> None:
        self.n, self.good = np.zeros(4, np.int64), True
        self.sha, self.said, self.links = hashlib.sha256(), [], []

    def add(self, n: np.ndarray, text: str, links: pa.Table, keep: bool) -> None:
        if self.n[2]:
            self.sha.update(b";")
        self.sha.update(text.encode())
        if keep:
            self.said.append(text)
        self.links.append(links)
        self.n += n

    def done(self) -> tuple:
        if not self.good or not self.n[0]:
            return np.zeros(4, np.int64), "", "", None
        links = self.links[0]
        if len(self.links) > 1:
            links = pa.concat_tables(self.links).group_by("pair", use_threads=False).aggregate(
                [("times", "sum")]).rename_columns(["pair", "times"])
        return self.n, self.sha.hexdigest(), ";".join(self.said), links


def _align_batch(units: Units, col: pa.Array, groups: bool) -> Iterator[tuple]:
    """(n, digest, group text, link table) of every row, in order."""
    data, off = utf8(col)
    held, at = None, -1  # the row that is being added up
    for first, buf, bounds in _parts(data, off):
        text, rows, size = _cut(buf, bounds)
        coded = pc.dictionary_encode(text)
        places = pc.take(units.find(coded.dictionary), coded.indices)
        bad = np.zeros(len(bounds) - 1, bool)
        bad[rows[~pc.take(units.exact, places).to_numpy(zero_copy_only=False)]] = True
        used = ~bad & (off[first + 1:first + len(bounds)] > off[first:first + len(bounds) - 1])
        cuts = np.searchsorted(np.cumsum(size), np.arange(0, len(buf), SLICE)[1:])
        for i, j in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            if i == j:
                continue
            own = rows[i:j]
            base, keep = int(own[0]), used[own]
            if keep.any():
                n, said, links = align_slice(units, places.slice(i, j - i).filter(pa.array(keep)),
                                             own[keep] - base)
                said, n_rows = said.to_pylist(), n.shape[1]
                ends = np.searchsorted(links["row"].to_numpy(), np.arange(n_rows + 1))
                links = links.select(["pair", "times"])
            else:
                n_rows = 0
            for k in range(int(own[-1]) - base + 1):
                if first + base + k != at:
                    if held is not None:
                        yield held.done()
                    held, at = _Row(), first + base + k
                held.good &= not bad[base + k]
                if k < n_rows and n[2, k]:
                    held.add(n[:, k], said[k], links.slice(ends[k], ends[k + 1] - ends[k]), groups)
    if held is not None:
        yield held.done()


def align(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B,
          groups: bool = False) -> DataFrame:
    """One written row per document: token, group and link counts, the digest
    of its groups, its id pairs with the number of links of each, and with
    ``groups`` the text of the groups (``a1,a2|b1;a3|b2,b3``) itself."""
    spark = docs.sparkSession
    schema = ALIGNED + (", groups string" if groups else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, row = units_of(path_a, path_b), TaskContext.get().partitionId() << 40
        for b in batches:
            if not b.num_rows:
                continue
            got = list(_align_batch(units, b.column("text"), groups))
            n = np.array([g[0] for g in got])
            lens = np.array([0 if g[3] is None else len(g[3]) for g in got])
            none = pa.table({"pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
            links = pa.concat_tables([none, *[g[3] for g in got if g[3] is not None]]).combine_chunks()
            off = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
            pairs, times = [links[c].combine_chunks() for c in ("pair", "times")]
            cols = [pa.array(row + np.arange(len(got))), b.column("doc_id"), *[pa.array(n[:, k]) for k in range(4)],
                    pa.array([g[1] for g in got]), pa.ListArray.from_arrays(off, pairs),
                    pa.ListArray.from_arrays(off, times.cast(pa.int32()))]
            if groups:
                cols.append(pa.array([g[2] for g in got]))
            row += len(got)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    bound_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return Scratch(spark, "align").write(plain.mapInArrow(run, schema))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): the documents that hold each id pair linked, counted
    in the tasks and merged by Spark, and whether no pair of its A id is in more."""
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part = pa.table({"pair": pc.list_flatten(b.column("pairs"))}).group_by(
            "pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "docs"])
        yield from part.combine_chunks().to_batches()

    scratch = Scratch(aligned.sparkSession, "pairs")
    counts = scratch.write(arrow_map(aligned.select("pairs"), run, "pair long, docs long")
                           .groupBy("pair").agg(F.sum("docs").alias("docs")))
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("_a")).agg(F.max("docs").alias("_top"))  # a row per id of A
    return scratch.write(counts.join(F.broadcast(top), a == F.col("_a"))
                         .select("pair", "docs", (F.col("docs") == F.col("_top")).alias("best")))


def _least_docs(counts: DataFrame, most: int) -> int:
    """A power of two that at most ``most`` pairs reach."""
    by = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("k")).count().collect()  # 64 rows at most
    held, least = 0, 64
    for r in sorted(by, key=lambda r: -r["k"]):
        held += r["count"]
        if held > most:
            break
        least = r["k"]
    return 1 << least if least < 63 else (1 << 63) - 1


def scored(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows of ``aligned`` with n_best and count_sum in place of the pairs."""
    spark = aligned.sparkSession
    least = _least_docs(counts, frequent)
    shared = spark.sparkContext.broadcast(
        counts.filter(F.col("docs") >= least).toArrow().combine_chunks())  # ``frequent`` rows at most
    names = [c for c in aligned.columns if c not in ("pairs", "times")]
    schema = ", ".join([f"{c} {t}" for c, t in aligned.select(*names).dtypes]
                       + ["n_best long", "count_sum long", "rare array<struct<pair:long,times:int>>"])
    item = pa.struct([pa.field("pair", pa.int64()), pa.field("times", pa.int32())])

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = shared.value
        pairs = b.column("pairs")
        flat, times = pc.list_flatten(pairs), pc.list_flatten(b.column("times"))
        row = pc.list_parent_indices(pairs).to_numpy()
        at = pc.index_in(flat, known["pair"].combine_chunks() if known.num_rows else pa.array([], pa.int64()))
        seen = at.is_valid().to_numpy(zero_copy_only=False)
        place, n = at.drop_null(), times.to_numpy().astype(np.int64)
        weight = n[seen] * pc.take(known["docs"], place).to_numpy()
        best = n[seen] * pc.take(known["best"], place).to_numpy()
        sums = pa.table({"row": row[seen], "best": best, "sum": weight}).group_by(
            "row", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
        out = np.zeros((2, b.num_rows), np.int64)
        for k, c in enumerate(("best_sum", "sum_sum")):
            out[k, sums["row"].to_numpy()] = sums[c].to_numpy()
        rest = ~seen
        off = np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=b.num_rows))])
        rare = pa.StructArray.from_arrays(
            [flat.filter(pa.array(rest)), times.filter(pa.array(rest))], fields=list(item))
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in names], pa.array(out[0]), pa.array(out[1]),
             pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), rare)],
            names=[*names, "n_best", "count_sum", "rare"])

    done = arrow_map(aligned, run, schema)
    if counts.filter(F.col("docs") < least).isEmpty():
        return done.drop("rare")
    done = Scratch(spark, "scored").write(done)
    found = done.select("row", F.explode("rare").alias("x")).select("row", "x.pair", "x.times").join(
        counts.filter(F.col("docs") < least), "pair")
    sums = found.groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"),
        F.sum(F.col("times") * F.col("docs")).alias("_sum"))
    return done.join(sums, "row", "left").select(
        *names, (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    return scored(aligned, pair_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
