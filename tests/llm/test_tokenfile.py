import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import tokenfile as K

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(K.TOKENIZER)


def brute(tok, docs):
    out, at = [], 0
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, K.END_ID]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()),
                  key=lambda x: x[1])


def test_registered_query_equals_plain_encoding(spark, tok):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    assert got(K.query(spark, D)) == brute(tok, docs)


def test_odd_rows_and_small_segments(spark, tok, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 7)
    docs = [(3, None), (1, ""), (2, " \n\t "), (None, "null id"), (9, "It's <|endoftext|> ΑΣ\x0bb\x1cc é"),
            (7, "long " * 5000), (11, "x" * 3000), (5, "same"), (5, "same"), (-4, "neg\r\nline nbsp em")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int").repartition(4)
    assert got(K.encode(df)) == brute(tok, docs)
    path = f"{K.Scratch(spark, 'test').root}/segments"
    K.write(df, path, segment_ids=5)
    assert K.read(spark, path).count() > 3
    assert got(K.digest(K.read(spark, path))) == brute(tok, docs)


def test_one_id_on_many_rows_is_split(spark):
    df = spark.createDataFrame([(1, f"w{i}") for i in range(500)], "doc_id long, text string")
    path = f"{K.Scratch(spark, 'test').root}/segments"
    K.write(df, path)
    assert K.read(spark, path).select("shard").distinct().count() > 3
    assert K.digest(K.read(spark, path)).count() == 500


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert K.encode(df).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300), st.data())
def test_pack_round_trip(bits, ids, data):
    ids = np.array([i % (1 << bits) for i in ids], np.uint32)
    assert (K.unpack(K.pack(ids, bits), len(ids), bits) == ids).all()
    assert len(K.pack(ids, bits)) == -(-len(ids) * bits // 8)
    s = K.Segment(K.encode_segment(ids, np.array([0, len(ids)]), bits))
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert (s.ids(a, b) == ids[a:b]).all() and (s.document(0) == ids).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    e = K.encoder()
    out = [[] for _ in texts]
    for row, ids, counts in e.batches(pa.array(texts, pa.string())):
        for r, part in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            out[row + r] = part.tolist()
    assert out == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(K, "CACHE_PIECES", 50)
    e = K.Encoder()
    for k in range(5):
        list(e.batches(pa.array([" ".join(f"w{k}x{i}" for i in range(30))])))
        assert len(e.length) <= 50


def test_joined_pieces_encode_as_alone():
    """Pieces go through the tokenizer many at a time; each keeps its own ids."""
    pool = "abzAZ09'’.,-_<|>\t\r\x0b\x85\xa0　​̧́क़İẞßéÀ漢字ガ각😀👩‍\x00﻿�"
    parts = [*pool, "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "don't", "</w>"]
    r = random.Random(1)
    pieces = ["".join(r.choice(parts) for _ in range(r.randint(1, 8))) for _ in range(3000)]
    enc = K.Encoder()
    want = [e.ids for e in enc.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
    flat, length = enc.encode(pieces)
    assert length.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]
    assert [len(x) for x in enc.encode([])] == [0, 0]
