import math
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from strata.llm import language as L
from tests.llm.helpers import rows

D = "/root/testdata/sf0.001"


def letter_runs(t):
    out, w = [], ""
    for c in (t or "").lower() + " ":
        if c.isalpha():
            w += c
        elif w:
            out.append(w)
            w = ""
    return out


def brute(train, texts, orders=L.ORDERS, smooth=L.SMOOTH):
    """The method over plain dictionaries."""
    names = [k for k, _ in sorted(Counter(x[1] for x in train).items(), key=lambda x: (-x[1], x[0]))]
    counts = {o: {k: Counter() for k in names} for o in (0, *orders)}
    for t, lang in train:
        for w in letter_runs(t):
            counts[0][lang][w] += 1
            for n in orders:
                counts[n][lang].update(w[i:i + n] for i in range(len(w) - n + 1))
    total = {o: sum(c.values(), Counter()) for o, c in counts.items()}
    total[0] = Counter({w: n for w, n in total[0].items() if n > 1})
    size = {o: {k: sum(counts[o][k][g] for g in total[o]) + smooth * (len(total[o]) + 1)
                for k in names} for o in total}
    logp = lambda o, g, k: math.log((counts[o][k][g] + smooth) / size[o][k])
    out = []
    for t in texts:
        ws = letter_runs(t)
        if not ws:
            out.append((L.UND, 0.0))
            continue
        s = dict.fromkeys(names, 0.0)
        for w in ws:
            grams, o = ([w], 0) if w in total[0] else ([], 0)
            for n in orders:
                if not grams:
                    grams, o = [w[i:i + n] for i in range(len(w) - n + 1)
                                if w[i:i + n] in total[n]], n
            for k in names:
                s[k] += sum(logp(o, g, k) for g in grams) / max(len(grams), 1)
        best = max(names, key=lambda k: s[k])
        out.append((best, 1 / sum(math.exp(s[k] - s[best]) for k in names)))
    return out


def held(i):
    return zlib.crc32(str(i if i is not None else "").encode()) % 5 == 0


def test_equals_plain_version_on_real_tables(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    train = [(r.text, r.lang) for r in docs if not held(r.doc_id) and r.lang and r.text]
    want = dict(zip([r.doc_id for r in docs], brute(train, [r.text for r in docs]), strict=True))
    for r in L.query(spark, D).collect():
        assert r.lang_pred == want[r.doc_id][0]
        assert r.score == pytest.approx(want[r.doc_id][1], abs=1e-3)
        assert r.held_out == held(r.doc_id)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = [(r.lang_pred, truth[r.doc_id]) for r in L.query(spark, d).collect() if r.held_out]
    assert sum(a == b for a, b in got) / len(got) > 0.97


def test_odd_rows(spark):
    data = [(1, "das ist ein Haus", "de"), (2, "das Haus ist alt", "de"), (3, "the house is old", "en"),
            (4, None, "en"), (5, "", "de"), (6, "123 !!", "en"), (7, "漢字", None),
            (8, "das alte Haus", None), (8, "das alte Haus", None), (None, "the old house", "en"),
            (9, "İİ das " * 20000, "de"), (10, "x", "en"), (11, "\U00010400", None)]
    data += [(100 + i, "das alte Haus ist das", "de") for i in range(20)]
    data += [(200 + i, "the house is old", "en") for i in range(20)]
    df = spark.createDataFrame([(*r, "z") for r in data],
                               "doc_id long, text string, lang string, lang_pred string").repartition(3)
    got = rows(L.identify(df), "doc_id")
    assert len(got) == len(data)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[4] == by[5] == by[6] == "und" and by[8] == "de" and by[9] == "de"
    assert by[7] in ("de", "en") and all(0 <= r["score"] <= 1 for r in got)
    kept = L.keep_known(df)
    assert kept.columns == df.columns and kept.count() == len(data) - 5
    # without a letter, or in scripts of which nothing was learned
    assert {r[0] for r in data} - {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, 11}


def test_nothing_to_learn_and_empty(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in L.identify(df).collect()] == [("und", 0.0)]
    assert L.identify(df.limit(0)).count() == 0


def test_bounded_fit_sample(spark):
    df = spark.createDataFrame([(i, "a b c", "en" if i % 2 else "de") for i in range(4000)],
                               "doc_id long, text string, lang string")
    model = L.fit(df, 100)
    assert sorted(model["langs"]) == ["de", "en"] and len(model["h"]) == 6
    pred, _ = L.predict(model, pa.array(["a", None]))
    assert pred[1] == "und"


def test_very_long_texts_come_in_pieces(monkeypatch):
    texts = ["das ist ein altes Haus und " * 50, "the old house " * 9, "", "x" * 900, "a b", None, "1 2 " * 400]
    rows = [(t, g) for t, g in (("das ist ein altes haus und", "de"), ("the old house is the", "en")) for _ in range(3)]
    h, n = {}, {}
    for t, g in rows:
        for b in L._count(pa.record_batch([[t], [g]], names=["text", "lang"])):
            for lang, order, k, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                h[(order, k)] = order
                n[(order, k, lang)] = n.get((order, k, lang), 0) + c
    keys = sorted(h, key=lambda x: x[1] & (2**64 - 1))
    model = {"langs": ["de", "en"], "h": L.np.array([k for _, k in keys], "i8").view("u8"),
             "logp": L.np.log(L.np.array([[n.get((o, k, g), 0) + 0.1 for g in ("de", "en")] for o, k in keys])).astype("f4")}
    whole = L.predict(model, pa.array(texts))
    monkeypatch.setattr(L.X, "SLICE", 100)
    cut = L.predict(model, pa.array(texts))
    assert whole[0] == cut[0] == ["de", "en", "und", cut[0][3], cut[0][4], "und", "und"]
    assert L.np.allclose(whole[1], cut[1])
    assert "".join(L._pieces(texts[0])) == texts[0] and len(list(L._pieces(texts[0]))) > 5


def test_stage_passes_all_on_without_labels_and_rejects_unknown_scripts(spark):
    rows = [(k, "the old house by the river", "en") for k in range(20)] + [
        (100, "日本語の文章", None), (101, "ελληνικό κείμενο", None), (102, "a river", None), (103, "...", None), (104, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in L.keep_known(docs).collect()} == {*range(20), 102}
    bare = docs.withColumn("lang", docs.lang.substr(9, 0)).selectExpr("doc_id", "text", "nullif(lang, '') AS lang")
    assert L.keep_known(bare).count() == len(rows)
