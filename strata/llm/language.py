"""Language identification by word-first backoff.

A word seen in training scores its log frequency in every language.  An
unseen word falls back to its character 4-grams, then 3-, 2- and 1-grams: the
longest length of which any n-gram is known gives the mean log frequency.  A
text's language is the one with the largest sum over all of its words.

The classifier is fitted on a bounded sample of labelled rows: about
``fit_docs`` training documents of every language, chosen by a hash of the id
(all of them where a language has fewer).  Counting runs on Spark; the model
that goes to the driver and is broadcast is bounded by that sample.  Every
whole text is predicted.

Cases: null text or text without a letter gives ``und`` and score 0; text
whose letters tell nothing (all n-grams unknown) gets the first learned
language; if nothing could be learned every language is ``und``; rows with
null lang are predicted but not learned from; a null id counts as the empty
text in the fold rule; repeated rows are predicted each on its own; other
columns are ignored by ``identify`` and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.llm.frames import arrow_map, crc_mod, table

FIT_DOCS = 2000        # labelled rows per language that the model is fitted on
ORDERS = (4, 3, 2, 1)  # character n-grams behind whole words (order 0)
SMOOTH = 0.1
FOLDS, HELD_FOLD = 5, 0
UND = "und"

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _char_values() -> np.ndarray:
    return X.mix64(np.arange(1, 0x10001, dtype=X.U64) * X.FILL)


class Chars:
    """Lower-cased code points of some rows, their words and n-gram hashes."""

    def __init__(self, texts: list[str]):
        texts = [t.lower() for t in texts]
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        self.start, self.end = X.spans_of(_letters()[cp], bounds[:-1])
        self.row_off = np.searchsorted(self.start, bounds)
        self.pw, self.inv = X._power_tables(len(cp) + 1)
        values = _char_values()[cp & 0xFFFF] + (cp >> 16).astype(X.U64) * X.FILL
        self.pre = np.empty(len(cp) + 1, X.U64)
        self.pre[0] = 0
        np.cumsum(values * self.pw[:len(cp)], out=self.pre[1:])

    def hash(self, s: np.ndarray, e: np.ndarray, order: int) -> np.ndarray:
        """Hash of the characters from ``s`` to ``e``, other for each order."""
        return X.mix64((self.pre[e] - self.pre[s]) * self.inv[s]
                       + (e - s + 64 * order).astype(X.U64) * X.FILL)

    def grams(self, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams of the given words: (index into ``word``, hash)."""
        many = np.maximum(self.end[word] - self.start[word] - n + 1, 0)
        of = np.repeat(np.arange(len(word)), many)
        at = self.start[word][of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        return of, self.hash(at, at + n, n)


def _pieces(text: str) -> Iterator[str]:
    """A very long text in pieces of about SLICE characters, cut at spaces (so
    never within a word)."""
    at = 0
    while len(text) - at > X.SLICE:
        cut = text.rfind(" ", at, at + X.SLICE)
        cut = cut if cut > at else text.find(" ", at + X.SLICE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _slices(col: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts in slices of bounded size with the row of each; a very long text
    comes in several slices."""
    _, off = X.utf8(col)
    for i, j in X.row_slices(off, X.SLICE):
        texts = [t or "" for t in col.slice(i, j - i).to_pylist()]
        if len(texts) > 1 or len(texts[0]) <= X.SLICE:
            yield np.arange(i, j), texts
        else:
            for piece in _pieces(texts[0]):
                yield np.array([i]), [piece]


# ---- fitting -------------------------------------------------------------

def _count(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams of a batch by language."""
    langs = b.column("lang").to_pylist()
    for rows, texts in _slices(b.column("text")):
        c = Chars(texts)
        row = np.repeat(np.arange(len(texts)), np.diff(c.row_off))
        lang_names, lang_of = np.unique(np.array([langs[r] for r in rows], object).astype(str),
                                        return_inverse=True)
        every = np.arange(len(c.start))
        for order in (0, *ORDERS):
            of, h = (every, c.hash(c.start, c.end, 0)) if not order else c.grams(every, order)
            lang = lang_of[row[of]]
            for k, name in enumerate(lang_names):
                key, n = np.unique(h[lang == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(key), pa.string()),
                     pa.array(np.full(len(key), order, np.int32)),
                     pa.array(key.view(np.int64)), pa.array(n)],
                    names=["lang", "grams", "h", "n"])


def fit(train: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    """Log frequencies of words and n-grams; ``train`` has doc_id, text, lang."""
    known = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    per = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not per:
        return {"langs": []}
    share = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, min(1.0, fit_docs / n))])
    unit = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(unit < share[F.col("lang")]).select("lang", "text")
    counts = (arrow_map(sample, _count, "lang string, grams int, h long, n long")
              .groupBy("lang", "grams", "h").agg(F.sum("n").alias("n")))
    # words seen once fall back to their n-grams
    total = counts.groupBy("grams", "h").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    names = sorted(per, key=lambda k: (-per[k], k))
    t = total.filter((F.col("n") > 1) | (F.col("grams") > 0)).select(
        "grams", "h", *[F.coalesce(F.col("by")[k], F.lit(0)).alias(f"n{i}")
                        for i, k in enumerate(names)]).toArrow()
    order = t["grams"].to_numpy()
    h = t["h"].to_numpy().view(X.U64) if t["h"].num_chunks < 2 else np.concatenate(
        [c.to_numpy() for c in t["h"].chunks]).view(X.U64)
    n = np.stack([t[f"n{i}"].to_numpy() for i in range(len(names))], 1).astype(np.float64)
    logp = np.empty_like(n)
    for k in np.unique(order):
        own = order == k
        logp[own] = np.log(n[own] + SMOOTH) - np.log(n[own].sum(0) + SMOOTH * (own.sum() + 1))
    at = np.argsort(h)
    return {"langs": names, "h": h[at], "logp": logp[at].astype(np.float32)}


# ---- prediction ----------------------------------------------------------

def _find(model: dict, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(model["h"]):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(model["h"], h), len(model["h"]) - 1)
    return at, model["h"][at] == h


def _totals(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of log frequencies by text and language, which have a letter, and
    which have a word or n-gram that was learned."""
    c = Chars(texts)
    score = np.zeros((len(c.start), len(model["langs"])))
    at, known = _find(model, c.hash(c.start, c.end, 0))
    score[known] = model["logp"][at[known]]
    rest = np.flatnonzero(~known)
    for n in ORDERS:
        if not len(rest):
            break
        of, h = c.grams(rest, n)
        at, known = _find(model, h)
        of, at = of[known], at[known]
        if len(of):
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            many = np.diff(np.concatenate([first, [len(of)]]))
            score[rest[of[first]]] = (np.add.reduceat(model["logp"][at], first, axis=0)
                                      / many[:, None])
            done = np.zeros(len(rest), bool)
            done[of] = True
            rest = rest[~done]
    cum = np.concatenate([np.zeros((1, score.shape[1])), np.cumsum(score, 0)])
    told = np.ones(len(c.start), np.int64)
    told[rest] = 0
    told = np.concatenate([[0], np.cumsum(told)])
    return (cum[c.row_off[1:]] - cum[c.row_off[:-1]], np.diff(c.row_off) > 0,
            told[c.row_off[1:]] > told[c.row_off[:-1]])


def predict(model: dict, col: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and posterior (even prior) of every text of a column."""
    pred, score = [UND] * len(col), np.zeros(len(col))
    if not model["langs"] or not len(col):
        return pred, score
    total, has = np.zeros((len(col), len(model["langs"]))), np.zeros(len(col), bool)
    for rows, texts in _slices(col):
        own, letters, _ = _totals(model, texts)
        total[rows] += own
        has[rows] |= letters
    e = np.exp(total - total.max(1, keepdims=True))
    best, post = total.argmax(1), e.max(1) / e.sum(1)
    for r in np.flatnonzero(has):
        pred[r], score[r] = model["langs"][best[r]], post[r]
    return pred, score


def _fitted(docs: DataFrame, fit_docs: int):
    train = docs.filter(crc_mod(F.col("doc_id"), FOLDS) != HELD_FOLD)
    return docs.sparkSession.sparkContext.broadcast(fit(train, fit_docs))


def identify(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Predicted language of every document, learned on the other folds."""
    model = _fitted(docs.select("doc_id", "text", "lang"), fit_docs)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pred, score = predict(model.value, b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()),
             pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    held = crc_mod(F.col("doc_id"), FOLDS) == HELD_FOLD
    return arrow_map(docs.select("doc_id", held.alias("held_out"), "text"), run, PREDICTED)


def told(model: dict, col: pa.Array) -> np.ndarray:
    """Which texts of a column have a word or n-gram that was learned."""
    out = np.zeros(len(col), bool)
    for rows, texts in _slices(col) if len(col) else ():
        out[rows] |= _totals(model, texts)[2]
    return out


def keep_known(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns, whose language can be told: texts in
    which some word or n-gram was learned.  If nothing could be learned, as no
    row has a label, all rows."""
    model = _fitted(docs.select("doc_id", "text", "lang"), fit_docs)
    if not model.value["langs"]:
        return docs

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield b.filter(pa.array(told(model.value, b.column("text"))))

    return arrow_map(docs, run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
