import hashlib
import re

from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm import mixing, tokenfile
from tests.llm import test_decontaminate, test_language, test_mixing, test_neardup, test_tokenfile

D = "/root/testdata/sf0.001"


def plain(rows, items):
    """The stages by their brute-force versions, over (id, text, lang, source)."""
    train = [(t, g) for d, t, g, _ in rows if not test_language.held(d) and g and t]
    told = test_language.brute(train, [r[1] for r in rows])
    rows = [r for r, (g, _) in zip(rows, told, strict=True) if g != "und"]
    kept = {r["doc_id"] for r in test_neardup.brute([r[:2] for r in rows], 5, 80) if r["kept"]}
    rows = [r for r in rows if r[0] in kept]
    hit = {r["doc_id"] for r in test_decontaminate.brute([r[:2] for r in rows], items) if r["contaminated"]}
    rows = [r for r in rows if r[0] not in hit]
    return rows, [r for r, p in zip(rows, rates(rows), strict=True)
                  if int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:8], 16) / 2**32 < p]


def rates(rows):
    def topic(t):
        return next((n for n, p in mixing.TOPICS if re.search(p, t)), mixing.OTHER)

    cell = [(s, g, topic(t)) for _, t, g, s in rows]
    n = {}
    for c, (_, t, _, _) in zip(cell, rows, strict=True):
        n[c] = n.get(c, 0) + max(len(re.findall(mixing.WORD, t)), 1)
    rate = test_mixing.plain(n, test_mixing.shares(n, mixing.TEMPER), P.KEEP)
    return [rate[c] for c in cell]


def test_equals_plain_stages(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    clean, mixed = plain(rows, items)
    assert len(mixed) < len(clean) < len(rows)
    tok = Tokenizer.from_file(tokenfile.TOKENIZER)
    assert test_tokenfile.got(P.run(spark, D)) == test_tokenfile.brute(tok, [r[:2] for r in mixed])


def test_stages_keep_columns_and_odd_rows(spark):
    data = [(1, "das alte Haus", None, None, 5), (None, None, "de", "s", None), (2, "", "de", "s", 0),
            (3, "!!!", "de", "s", 3), (4, "x " * 20000, "en", "s", 4), (4, "x " * 20000, "en", "s", 4),
            (5, "unlike any other text", "en", None, 1), (None, "a text without an id", "en", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), D).count() == 0, name
        out.collect()
    assert {r.doc_id for r in P.known_language(spark, docs, D).collect()} == {1, 4, 5, None}
    assert P.known_language(spark, docs, D).count() == 5
    assert sorted(str(r.doc_id) for r in P.near_dedup(spark, docs, D).collect()) == sorted(
        map(str, [1, None, 2, 3, 4, 5, None]))
    assert P.token_file(spark, docs, D).count() == len(data)
