"""Mixing to target weights by iterative proportional fitting, SQL only.

Documents are counted into cells (source, language, topic) of token weight.  A
cell's documents are kept with probability min(1, a * b * c): a factor for its
source, one for its language and one for its topic.  A round rakes the three
marginals in turn: each category's factor is set so that the weight it keeps
meets its target, with the cells that reach probability 1 kept whole and the
rest raked over the others.  All targets together add up to ``keep`` of all
weight, so a rare category cannot set the scale for all documents.  A document
is kept if a hash of its id, as a number from 0 to 1, lies below its
probability: the same for every run, however the rows are dealt out.

Rounds go on until every step finds its category within ``SETTLED`` of the
target or without a cell that could give more, or the largest error falls no
further, ``ROUNDS`` at most.  Targets that contradict each other, or ask for more
weight than there is, are warned about with what is missed.

Targets: by default each category's share of all weight to the power of its
marginal's temper (1 keeps the mix, 0 makes it even), scaled to 1.  A table
(value, share) may be given instead for any marginal; categories it does not
name get no weight, and shares are scaled to the categories that exist.

Only cells, one row for each combination that occurs, go through the rounds, and
each round is written: by window sums while all cells may meet in one task
(``WINDOW_CELLS``), else by sums of each category, taken in the tasks first, and
written tables of factors.  Documents are read twice, to count and to look up their cell's rate.

Cases: null source, language or topic is a category of its own; a document
without words weighs 1, so it has a rate too; a null id hashes as the empty
text; repeated rows share one decision; an empty table gives no rows; extra
columns are ignored by ``rates`` and kept by ``sample``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, small, table

DIMS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 1.0}
KEEP = 0.6               # share of all weight that is kept
ROUNDS = 12
WINDOW_CELLS = 1 << 20   # cells that may meet in one task
SETTLED = 1e-4           # relative error of a category at which raking ends
PATIENCE, STALLED = 4, 0.9  # from this round on, an error that falls no further ends it
TOLERANCE = 1e-2         # error of a target share that is reported
SEED = "mix"

# Topics by what a text contains, first match wins (fixed values).
TOPICS = (("legal", "(?i)licen[cs]e"), ("table", r" \| "), ("numbers", "[0-9]{6,}"))
OTHER = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: str = "text") -> Column:
    t = F.coalesce(F.col(text), F.lit(""))
    return F.coalesce(*[F.when(t.rlike(p), F.lit(name)) for name, p in TOPICS], F.lit(OTHER))


def tokens_of(text: str = "text") -> Column:
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)))
    return F.greatest(words, F.lit(1)).cast("long")


def _targets(cells: DataFrame, dim: str, given: DataFrame | None, temper: float, keep: float,
             scratch: Scratch) -> DataFrame:
    """(dim, target weight): shares of ``keep`` of all weight over the
    categories that occur."""
    own = cells.groupBy(dim).agg(F.sum("n").cast("double").alias("raw"))
    total = cells.agg(F.sum("n").cast("double").alias("t"))
    if given is None:
        own = own.withColumn("raw", F.pow(F.col("raw") / total.scalar(), F.lit(temper)))
    else:
        want = given.select(F.col("value").alias("_v"), F.col("share").cast("double").alias("_s"))
        own = (own.join(want, F.col(dim).eqNullSafe(F.col("_v")), "left")
               .select(dim, F.coalesce("_s", F.lit(0.0)).alias("raw")))
    own = scratch.write(own)
    whole = own.agg(F.sum("raw").alias("t"))
    return own.select(
        F.col(dim).alias(f"_{dim}"),
        (F.col("raw") / whole.scalar() * total.scalar() * F.lit(float(keep))).alias("target"),
        F.lit(float(keep)).alias("f"), F.lit(0.0).alias("off"))


def _with_factors(cells: DataFrame, factors: dict[str, DataFrame], sizes: dict[str, int]) -> DataFrame:
    """Cells with the factor of each of their categories (f_source, ...)."""
    for d in DIMS:
        f = small(factors[d].select(f"_{d}", F.col("f").alias(f"f_{d}")), sizes[d], 64)
        cells = cells.join(f, F.col(d).eqNullSafe(F.col(f"_{d}"))).drop(f"_{d}")
    return cells


RATE = reduce(lambda a, b: f"{a} * {b}", [f"f_{d}" for d in DIMS])


def _stepped(t: Column, f: Column) -> tuple[Column, Column]:
    """The factor with which kept weight meets the target ``t``, and how far
    from it the category was before.

    Cells at probability 1 (``fixed``) count whole; the others (``free``) are
    scaled to what is left of the target.  If the whole ones alone exceed it,
    all are scaled down.  A category without a cell that could give more is as
    near as it can be.
    """
    fixed, free = F.col("fixed"), F.col("free")
    new = (F.when((t > fixed) & (free > 0), f * (t - fixed) / free)
           .when((t <= fixed) & (fixed + free > 0), f * t / (fixed + free)).otherwise(f))
    stuck = (t == 0) | ((t > fixed) & (free == 0))
    return new, F.when(stuck, 0.0).otherwise(F.abs((fixed + free) / t - 1))


def _raked(cells: DataFrame, dim: str, factors: dict[str, DataFrame], sizes: dict[str, int]) -> DataFrame:
    """The factors of ``dim`` after one step."""
    n, r = F.col("n"), F.expr(RATE)
    mass = _with_factors(cells, factors, sizes).groupBy(dim).agg(
        F.coalesce(F.sum(F.when(r >= 1, n)), F.lit(0)).cast("double").alias("fixed"),
        F.coalesce(F.sum(F.when(r < 1, n * r)), F.lit(0.0)).alias("free"))
    new, off = _stepped(F.col("target"), F.col("f"))
    return (factors[dim].drop("off").join(small(mass, sizes[dim], 64), F.col(f"_{dim}").eqNullSafe(F.col(dim)))
            .select(f"_{dim}", "target", new.alias("f"), off.alias("off")))


def _round(fitted: DataFrame) -> DataFrame:
    """A round over a table of at most ``WINDOW_CELLS`` cells that carry their
    targets and factors: the same steps with window sums."""
    for d in DIMS:
        own = Window.partitionBy(d)
        n, r = F.col("n"), F.expr(RATE)
        fitted = fitted.withColumns({
            "fixed": F.coalesce(F.sum(F.when(r >= 1, n)).over(own), F.lit(0)).cast("double"),
            "free": F.coalesce(F.sum(F.when(r < 1, n * r)).over(own), F.lit(0.0))})
        new, off = _stepped(F.col(f"t_{d}"), F.col(f"f_{d}"))
        fitted = fitted.withColumns({f"o_{d}": off, f"f_{d}": new}).drop("fixed", "free")
    return fitted


def _rounds_by_windows(cells: DataFrame, factors: dict[str, DataFrame], sizes: dict[str, int],
                       scratch: Scratch) -> Iterator[tuple[float, DataFrame]]:
    """After each round its largest error and the cells with their factors."""
    fitted = cells
    for d in DIMS:
        own = small(factors[d].select(f"_{d}", F.col("target").alias(f"t_{d}"), F.col("f").alias(f"f_{d}")), sizes[d], 64)
        fitted = fitted.join(own, F.col(d).eqNullSafe(F.col(f"_{d}"))).drop(f"_{d}")
    while True:
        old, fitted = fitted, scratch.write(_round(fitted))
        scratch.drop(old)
        yield fitted.agg(F.max(F.greatest(*[f"o_{d}" for d in DIMS]))).first()[0] or 0.0, fitted


def _rounds_by_tables(cells: DataFrame, factors: dict[str, DataFrame], sizes: dict[str, int],
                      scratch: Scratch) -> Iterator[tuple[float, DataFrame]]:
    """The same for any number of cells: a category is summed up in the tasks
    first, so one that nearly all cells share is no hot key."""
    while True:
        off = 0.0
        for d in DIMS:
            old, factors[d] = factors[d], scratch.write(_raked(cells, d, factors, sizes))
            scratch.drop(old)
            off = max(off, factors[d].agg(F.max("off")).first()[0] or 0.0)
        yield off, _with_factors(cells, factors, sizes)


def rates(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
          keep: float = KEEP) -> DataFrame:
    """(source, lang, topic, rate) of every cell of ``docs``, which has these
    columns and ``tokens``; ``keep`` is the share of all weight to be kept."""
    scratch = Scratch(docs.sparkSession, "mixing")
    cells = scratch.write(docs.groupBy(*DIMS).agg(F.sum("tokens").alias("n")))
    wanted = {d: _targets(cells, d, (targets or {}).get(d), {**TEMPER, **(temper or {})}[d], keep, scratch)
              for d in DIMS}
    sizes = {d: f.count() for d, f in wanted.items()}
    rounds = _rounds_by_windows if cells.count() <= WINDOW_CELLS else _rounds_by_tables
    last = float("inf")
    for k, (off, fitted) in enumerate(rounds(cells, dict(wanted), sizes, scratch), 1):
        if off <= SETTLED or k == ROUNDS or (k >= PATIENCE and off > STALLED * last):
            break
        last = off
    fitted = scratch.write(fitted.select(*DIMS, "n", F.least(F.lit(1.0), F.expr(RATE)).alias("rate")))
    _report(fitted, wanted)
    return fitted.select(*DIMS, "rate")


def _report(fitted: DataFrame, factors: dict[str, DataFrame]) -> None:
    """Warn about targets that are missed."""
    for d in DIMS:
        kept = fitted.groupBy(d).agg(F.sum(F.col("rate") * F.col("n")).alias("w"))
        off = factors[d].filter("target > 0").join(kept, F.col(f"_{d}").eqNullSafe(F.col(d))).agg(
            F.max(F.abs(F.col("w") / F.col("target") - 1))).first()[0]
        if (off or 0) > TOLERANCE:
            warnings.warn(f"mix: a target share of {d} is missed by {off:.1%}", stacklevel=3)


def unit_of(doc_id: str = "doc_id") -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    text = F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])


def mix(docs: DataFrame, topic: Column | None = None, **options) -> DataFrame:
    """Every document with its cell, weight, probability and decision."""
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.write(docs.select(
        "doc_id", "source", "lang", (topic if topic is not None else topic_of()).alias("topic"),
        tokens_of().alias("tokens")))
    r = rates(rows, **options).select(*[F.col(d).alias(f"_{d}") for d in DIMS], "rate")
    return (rows.join(r, _same([F.col(d) for d in DIMS], [F.col(f"_{d}") for d in DIMS]))
            .select("doc_id", *DIMS, "tokens", F.round("rate", 6).alias("rate"),
                    (unit_of() < F.col("rate")).alias("kept")))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that the mix keeps."""
    names = [f"_c{k}" for k in range(len(docs.columns))]  # clash with nothing
    plain = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in ("doc_id", "text", "source", "lang")}
    cells = plain.select(F.col(at["source"]).alias("source"), F.col(at["lang"]).alias("lang"),
                         topic_of(at["text"]).alias("topic"), tokens_of(at["text"]).alias("tokens"))
    r = rates(cells, **options)
    topic = plain.withColumn("_topic", topic_of(at["text"]))
    same = _same([F.col(at["source"]), F.col(at["lang"]), F.col("_topic")],
                 [F.col(d) for d in DIMS])
    return (topic.join(r, same).filter(unit_of(at["doc_id"]) < F.col("rate"))
            .select(*names).toDF(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    topic = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in TOPICS)
    out = [f"""WITH RECURSIVE d AS (SELECT doc_id, source, lang, CASE {topic} ELSE '{OTHER}' END AS topic,
  greatest(len(regexp_extract_all(coalesce(text, ''), '{WORD}')), 1) AS tokens FROM documents),
c AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS n FROM d GROUP BY ALL)"""]
    for k in DIMS:
        out.append(f"""p_{k} AS (SELECT {k}, pow(sum(n)::DOUBLE / (SELECT sum(n)::DOUBLE FROM c),
  {TEMPER[k]}) AS raw FROM c GROUP BY {k}),
s_{k} AS (SELECT {k}, raw / (SELECT sum(raw) FROM p_{k}) * (SELECT sum(n)::DOUBLE FROM c) * {KEEP}::DOUBLE AS t
  FROM p_{k})""")
    join = " ".join(f"JOIN s_{k} ON c.{k} IS NOT DISTINCT FROM s_{k}.{k}" for k in DIMS)
    step = (f"SELECT * FROM it WHERE k < {ROUNDS} AND off > {SETTLED} "
            f"AND (k < {PATIENCE} OR off <= {STALLED} * last)")
    for d in DIMS:
        step = f"""SELECT * EXCLUDE (fixed, free) REPLACE (
    CASE WHEN t_{d} > fixed AND free > 0 THEN f_{d} * (t_{d} - fixed) / free
         WHEN t_{d} <= fixed AND fixed + free > 0 THEN f_{d} * t_{d} / (fixed + free) ELSE f_{d} END AS f_{d},
    CASE WHEN t_{d} = 0 OR (t_{d} > fixed AND free = 0) THEN 0.0::DOUBLE
         ELSE abs((fixed + free) / t_{d} - 1) END AS o_{d})
  FROM (SELECT *, coalesce(sum(CASE WHEN {RATE} >= 1 THEN n END) OVER (PARTITION BY {d}), 0)::DOUBLE AS fixed,
    coalesce(sum(CASE WHEN {RATE} < 1 THEN n * ({RATE}) END) OVER (PARTITION BY {d}), 0)::DOUBLE AS free
  FROM ({step}) y) z"""
    cols = ", ".join(f"t_{d}, f_{d}, o_{d}" for d in DIMS)
    first = ", ".join(f"s_{d}.t AS t_{d}, {KEEP}::DOUBLE AS f_{d}, 0.0::DOUBLE AS o_{d}" for d in DIMS)
    out.append(f"""it AS (SELECT 0 AS k, 1.0::DOUBLE AS off, 'inf'::DOUBLE AS last, c.source, c.lang, c.topic, n, {first} FROM c {join}
  UNION ALL SELECT k + 1, max(greatest(o_source, o_lang, o_topic)) OVER () AS off, CASE WHEN k = 0 THEN 'inf'::DOUBLE ELSE off END AS last,
    source, lang, topic, n, {cols}
  FROM ({step}) x)""")
    out.append(f"""r AS (SELECT source, lang, topic, least(1.0::DOUBLE, {RATE}) AS rate FROM it
  WHERE k = (SELECT max(k) FROM it))""")
    return ",\n".join(out) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(r.rate, 6) AS rate,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
    / 4294967296.0::DOUBLE < r.rate AS kept
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang
  AND d.topic = r.topic"""


ORACLE = _oracle()
