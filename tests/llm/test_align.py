import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strata.llm import align as K

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(K.TOKENIZER_A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=K.TOKENIZER_B)


def plain_tokens(coders, text):
    """Ids and byte strings of both tokenizations of a whole text, token by token."""
    a, b = coders
    letters = K._byte_of_letter()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    said_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    said_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
              else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    return ids_a, said_a, ids_b, said_b


def plain(coders, docs):
    """Quadratic version: all token pairs of a document are tried."""
    found, counts = [], Counter()
    for doc, text in docs:
        links, groups, n = [], [], (0, 0)
        if text:
            ia, sa, ib, sb = plain_tokens(coders, text)
            if b"".join(sa) == b"".join(sb) == (" " + text).encode():
                ends = [np.cumsum([len(s) for s in x]).tolist() for x in (sa, sb)]
                begins = [[0, *e[:-1]] for e in ends]
                links = [(x, y) for i, x in enumerate(ia) for j, y in enumerate(ib)
                         if begins[0][i] < ends[1][j] and begins[1][j] < ends[0][i]]
                n, last = (len(ia), len(ib)), 0
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    groups.append([[str(i) for i, e in zip(ids, es, strict=True) if last < e <= cut]
                                   for ids, es in ((ia, ends[0]), (ib, ends[1]))])
                    last = cut
        said = ";".join("|".join(",".join(side) for side in g) for g in groups)
        counts.update(set(links))
        found.append((doc, *n, groups, links, said))
    best = {}
    for (x, _), c in counts.items():
        best[x] = max(best.get(x, 0), c)
    return sorted(((d, na, nb, len(g), len(k), sum(counts[p] == best[p[0]] for p in k),
                    sum(counts[p] for p in k), hashlib.sha256(s.encode()).hexdigest() if s else "")
                   for d, na, nb, g, k, s in found), key=str)


COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces  "), (5, "a\n \n b"), (6, "x  y 　z"),
       (7, "<|endoftext|> <s> </s> <unk>"), (8, "under▁score"), (9, "café naïve \U0001f600 漢字"),
       (10, "it's we'll I'm 1234567 !!! ..."), (None, "null id"), (11, "same text"), (11, "same text"),
       (12, "tab\tand\r\nline  \n"), (13, "\x00\x01 nul"), (14, "é İ ﬁ fi")]


def test_odd_texts_equal_plain_version(spark, coders):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in ODD],
                               "doc_id long, text string, pairs int, row int").repartition(3)
    aligned = K.align(df)
    want = plain(coders, ODD)
    assert got(K.scored(aligned, K.pair_counts(aligned))) == want
    assert [w for w in want if w[0] == 8] == [(8, 0, 0, 0, 0, 0, 0, "")]


def test_rare_pairs_by_join_equal_broadcast(spark, coders):
    docs = ODD + [(20 + k, f"the common words and word{k}") for k in range(30)]
    aligned = K.align(spark.createDataFrame(docs, "doc_id long, text string"))
    counts = K.pair_counts(aligned)
    want = plain(coders, docs)
    for frequent in (0, 5, 40, 1 << 20):
        assert got(K.scored(aligned, counts, frequent)) == want
    assert K._least_docs(counts, 5) > 1


def test_slices_and_small_cache(monkeypatch):
    units = K.Units(K.TOKENIZER_A, K.TOKENIZER_B)
    docs = [t for _, t in ODD] + ["some words, déjà vu " * 60, "", None, "x" * 500]
    whole = list(K._align_batch(units, pa.array(docs), True))
    for part, size in ((100, 40), (30, 1 << 20), (1 << 20, 9)):
        monkeypatch.setattr(K, "PART", part)
        monkeypatch.setattr(K, "SLICE", size)
        monkeypatch.setattr(K, "CACHE_UNITS", 20)
        same(whole, list(K._align_batch(K.Units(K.TOKENIZER_A, K.TOKENIZER_B), pa.array(docs), True)))


def same(whole, cut):
    assert len(whole) == len(cut)
    for x, y in zip(whole, cut, strict=True):
        assert x[0].tolist() == y[0].tolist() and x[1:3] == y[1:3]
        assert (x[3] is None) == (y[3] is None)
        if x[3] is not None:
            assert sorted(map(tuple, zip(*x[3].to_pydict().values(), strict=True))) == \
                sorted(map(tuple, zip(*y[3].to_pydict().values(), strict=True)))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab \n\t'sA9.é  ▁́\U0001f600<|>"), max_size=40))
def test_units_encode_like_the_whole_text(text):
    units = K.units_of(K.TOKENIZER_A, K.TOKENIZER_B)
    tok = Tokenizer.from_file(K.TOKENIZER_A)
    tok.encode_special_tokens = True
    if not text:
        return
    sp = units.coders[1].model
    said = np.frombuffer((" " + text).encode(), np.uint8)
    cut, _, _ = K._cut(said, np.array([0, len(said)]))
    coded = cut.dictionary_encode()
    at = pa.compute.take(units.find(coded.dictionary), coded.indices)
    ids = [pa.compute.list_flatten(pa.compute.take(units.lists[k], at)).to_pylist() for k in (0, 1)]
    assert ids[0] == tok.encode(" " + text, add_special_tokens=False).ids
    exact = all(pa.compute.take(units.exact, at).to_pylist())
    assert exact == (b"".join(units.coders[1].bytes[i] for i in sp.encode(text)) == (" " + text).encode())
    if exact:
        assert ids[1] == sp.encode(text)


def test_registered_query_equals_plain_version(spark, coders):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    short = [d for d in docs if len(d[1]) < 1500]
    aligned = K.align(spark.createDataFrame(short, "doc_id long, text string"), groups=True)
    assert got(K.scored(aligned, K.pair_counts(aligned))) == plain(coders, short)
    r = aligned.filter("n_a > 0").first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
    full = {r.doc_id: r for r in K.query(spark, D).collect()}
    assert len(full) == len(docs)
    for d, t in docs:
        ia, _, ib, _ = plain_tokens(coders, t)
        assert (full[d].n_a, full[d].n_b) in ((len(ia), len(ib)), (0, 0))
        assert full[d].n_links == full[d].n_a + full[d].n_b - full[d].n_groups


def test_empty(spark):
    aligned = K.align(spark.createDataFrame([], "doc_id long, text string"))
    assert got(K.scored(aligned, K.pair_counts(aligned))) == []
