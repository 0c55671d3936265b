"""Merkle manifest of a table: a content-addressed DAG, proofs by descent.

Leaves are digests of whole rows.  Within a language they ascend by id, and
every ``FAN`` consecutive nodes become their parent until one is left, the
subroot; subroots, ordered by language, are joined to the root in the same way.
The store holds one record for each inner digest: digest, children (their hex
texts, one after the other), tree and height.  Equal subtrees share a record.

A proof is taken from the store alone.  Requests are (language, rank); the
digits of a rank, base ``FAN``, are the way down from the root.  All requests
descend together, one row for each distinct node on their ways: a step looks up
the node's record by digest, goes on to the children asked for and keeps the
children not chosen as a segment.  Segments, reversed, are the proof from leaf
to root.  Rows fan out to single leaves in the last step only, so what is
shuffled is about an eighth of the proofs.

Ranks come from ranges of (language, id, digest), so one language or id on a
third of all rows is split; no group holds more than ``FAN`` nodes.

Cases: a null value is marked ``-`` and differs from an empty text; the null
language is the first one; rows with a null id come first, rows of equal ids
are ordered by digest, and equal rows are leaves of their own; a lone leaf is
its subroot, a lone subroot the root, and an empty table has no root and no
rows; other columns take no part.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, crc_mod, small, table
from strata.llm.ranges import deal, runs

FAN_BITS = 3
FAN = 1 << FAN_BITS
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "CAST(array() AS array<struct<before:string,after:string>>)"


class Manifest(NamedTuple):
    nodes: DataFrame   # digest, children, tree ('lang' or 'root'), height
    leaves: DataFrame  # lang_at, rank, doc_id, leaf and the carried columns
    langs: DataFrame   # lang_at, lang, n, depth, subroot
    root: str | None
    root_depth: int


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each with its length in bytes."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in text]), 256)


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return reduce(Column.__add__, [(n > FAN ** k).cast("int") for k in range(21)])


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _ranked(rows: DataFrame, group: str, order: list[str], scratch: Scratch):
    """(rows with their part and place, one row per part and group with the
    rank of its first): written, dealt into ranges and sorted."""
    dealt = deal(rows, group, order, scratch)
    own = runs(dealt, group, {"n": F.lit(1)}, _first=F.min("_place"))
    return dealt, scratch.write(own.withColumnsRenamed({"total_n": "n", "before_n": "_rank"}))


def _levels(level: DataFrame, most: int, scratch: Scratch):
    """(records of each height from 1, tops): ``level`` has g, at, n and digest."""
    records, tops = [], []
    while True:
        tops.append(level.filter("n = 1").select("g", "digest"))
        if most <= 1:
            return records, reduce(DataFrame.unionByName, tops)
        kids = F.array_sort(F.collect_list(F.struct("at", "digest")))  # FAN at most
        up = (level.filter("n > 1")
              .groupBy("g", F.shiftright("at", FAN_BITS).alias("up"),
                       F.ceil(F.col("n") / FAN).cast("long").alias("n"))
              .agg(F.array_join(F.transform(kids, lambda x: x["digest"]), "").alias("children")))
        up = scratch.write(up.withColumn("digest", F.sha2("children", 256)))
        records.append(up.select("digest", "children"))
        level, most = up.select("g", F.col("up").alias("at"), "n", "digest"), -(-most // FAN)


def _records(levels: list[DataFrame], tree: str) -> list[DataFrame]:
    return [r.withColumns({"tree": F.lit(tree), "height": F.lit(h + 1)}) for h, r in enumerate(levels)]


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS,
          carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: groups by lang, ids in doc_id.  Columns of
    ``carry`` are computed in the same pass and kept beside the leaves."""
    scratch = Scratch(docs.sparkSession, "merkle")
    more = {k: v.alias(k) for k, v in (carry or {}).items()}
    rows = docs.select("lang", "doc_id", leaf_digest(*[F.col(c) for c in fields]).alias("leaf"),
                       *more.values())
    dealt, runs = _ranked(rows, "lang", ["doc_id", "leaf"], scratch)
    own = runs.groupBy("lang").agg(F.max("n").alias("n")).withColumn("g", F.lit(0))
    own, own_runs = _ranked(own.withColumnRenamed("n", "n_leaves"), "g", ["lang"], scratch)
    langs = scratch.write(own.join(F.broadcast(own_runs.select("_part", "_first", "_rank")), "_part")  # a row per part
                          .select((F.col("_rank") + F.col("_place") - F.col("_first")).alias("lang_at"),
                                  "lang", F.col("n_leaves").alias("n")))
    n_langs = langs.count()
    if not n_langs:
        none = langs.select("lang_at", "lang", "n", F.lit(0).alias("depth"), F.lit("").alias("subroot"))
        nodes = docs.sparkSession.createDataFrame([], "digest string, children string, tree string, height int")
        leaves = dealt.select(F.lit(0).cast("long").alias("lang_at"), F.col("_place").alias("rank"),
                              "doc_id", "leaf", *more)
        return Manifest(nodes, leaves, none, None, 0)
    at = langs.select("lang_at", F.col("lang").alias("_lang"))
    placed = scratch.write(
        runs.join(small(at, n_langs, 64), _same("lang", "_lang"))
        .select("_part", F.col("lang").alias("_lang"), "lang_at", "n",
                (F.col("_rank") - F.col("_first")).alias("_shift")))
    leaves = scratch.write(
        dealt.withColumnRenamed("_part", "_own").join(
            small(placed, placed.count(), 64), (F.col("_own") == F.col("_part")) & _same("lang", "_lang"))
        .select("lang_at", (F.col("_place") + F.col("_shift")).alias("rank"), "n", "doc_id", "leaf", *more))
    scratch.drop(dealt)
    most = langs.agg(F.max("n")).first()[0]
    lang_levels, tops = _levels(leaves.select(F.col("lang_at").alias("g"), F.col("rank").alias("at"), "n",
                                              F.col("leaf").alias("digest")), most, scratch)
    tops = tops.select(F.col("g").alias("lang_at"), F.col("digest").alias("subroot"))
    langs = scratch.write(langs.withColumn("depth", _depth(F.col("n"))).join(tops, "lang_at"))
    root_levels, top = _levels(langs.select(F.lit(0).cast("long").alias("g"), F.col("lang_at").alias("at"),
                                            F.lit(n_langs).cast("long").alias("n"),
                                            F.col("subroot").alias("digest")), n_langs, scratch)
    nodes = [*_records(lang_levels, "lang"), *_records(root_levels, "root")]
    none = docs.sparkSession.createDataFrame([], "digest string, children string, tree string, height int")
    return Manifest(reduce(DataFrame.unionByName, nodes, none), leaves.drop("n"), langs,
                    top.first()["digest"], len(root_levels))


def _step(front: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One level down: (g, at, digest, path) and a column ``want`` of wanted."""
    record = nodes.groupBy("digest").agg(F.min("children").alias("children"))  # equal subtrees share one
    want = wanted.select(F.col("g").alias("_g"), F.col("at").alias("_at"), "want")
    down = (front.join(record, "digest")
            .join(want, (F.col("g") == F.col("_g")) & (F.col("at") == F.col("_at")))
            .select("g", "at", "children", "path", F.explode("want").alias("want")))
    first = F.col("want.digit") * HEX
    part = lambda a, n: F.substring(F.col("children"), a, n)
    segment = F.struct(part(F.lit(1), first).alias("before"),
                       part(first + (HEX + 1), F.lit(FAN * HEX)).alias("after"))
    return down.select("g", (F.col("at") * FAN + F.col("want.digit")).alias("at"),
                       part(first + 1, F.lit(HEX)).alias("digest"),
                       F.concat("path", F.array(segment)).alias("path"), "want")


def _descend(starts: DataFrame, nodes: DataFrame, requests: DataFrame, most: int,
             scratch: Scratch) -> DataFrame:
    """Every request (g, at, load) with the segments on its way from its start
    (g, depth, digest, path) and the digest that it ends at."""
    digit = F.col("at").bitwiseAND(F.lit(FAN - 1)).cast("int").alias("digit")
    wanted = [scratch.write(requests.groupBy("g", F.shiftright("at", FAN_BITS).alias("at")).agg(
        F.collect_list(F.struct(digit, "load")).alias("want")))] if most else []
    for _ in range(1, most):
        wanted.append(scratch.write(wanted[-1].groupBy("g", F.shiftright("at", FAN_BITS).alias("at")).agg(
            F.collect_set(F.struct(digit)).alias("want"))))
    flat = starts.filter("depth = 0").select(F.col("g").alias("_g"), "digest", "path")
    done = requests.join(flat, F.col("g") == F.col("_g")).select("g", "at", "load", "digest", "path")
    front = None
    for h in range(most, 0, -1):
        begin = starts.filter(F.col("depth") == h).select("g", F.lit(0).cast("long").alias("at"), "digest", "path")
        front = begin if front is None else front.drop("want").unionByName(begin)
        front = _step(front, nodes.filter(F.col("height") == h), wanted[h - 1])
        if h > 1:
            front = scratch.write(front)
    if front is not None:
        done = done.unionByName(front.select("g", "at", F.col("want.load").alias("load"), "digest", "path"))
    return done


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests``, rows of the manifest's leaves, with subroot and proof:
    the children not chosen (before, after the chosen one), from leaf to root."""
    spark = requests.sparkSession
    scratch = Scratch(spark, "proofs")
    if manifest.root is None:
        return requests.select("*", F.lit("").alias("subroot"), F.expr(PATH).alias("proof"))
    top = spark.createDataFrame([(0, manifest.root_depth, manifest.root)], "g long, depth int, digest string")
    of = lambda tree: manifest.nodes.filter(F.col("tree") == tree)
    langs = _descend(top.withColumn("path", F.expr(PATH)), of("root"),
                     manifest.langs.select(F.lit(0).cast("long").alias("g"), F.col("lang_at").alias("at"),
                                           F.struct("lang_at", "depth").alias("load")),
                     manifest.root_depth, scratch)
    starts = scratch.write(langs.select(F.col("load.lang_at").alias("g"), F.col("load.depth").alias("depth"),
                                        "digest", "path"))
    most = starts.agg(F.max("depth")).first()[0]
    found = _descend(starts, of("lang"), requests.select(
        F.col("lang_at").alias("g"), F.col("rank").alias("at"), F.struct(*requests.columns).alias("load")),
        most, scratch)
    sub = manifest.langs.select(F.col("lang_at").alias("g"), "subroot")
    found = found.join(small(sub, sub.count(), 96), "g")
    return found.select("load.*", "subroot", F.reverse("path").alias("proof"))


def proof_digest(proof: str = "proof") -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, proof: str = "proof") -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", UPPER, UPPER.lower())
    tampered = leaf_digest(*[lower if c == "text" else F.col(c) for c in FIELDS])
    m = build(table(spark, sf_dir, "documents"),
              carry={"claim": F.when(crc_mod(F.col("doc_id"), 3) == 0, tampered)})
    proofs = prove(m, m.leaves)
    return proofs.select("doc_id", "leaf", "subroot", F.lit(m.root).alias("root"),
                         proof_digest().alias("proof_sha256"),
                         folded(F.coalesce("claim", "leaf")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


# ---- the same in SQL ---------------------------------------------------------

def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


def _oracle(lang_levels: int = 8, root_levels: int = 4) -> str:
    """``FAN`` to the power of the levels bounds leaves and languages."""
    def h(text: str) -> str:
        each = [text if c == "text" else f"{c}::VARCHAR" for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({e}) || ':' || {e}, '-')" for e in each) + ")"

    def tree(name: str, group: str, levels: int) -> list[str]:
        """{name}0 has g, pos, n, digest; x is carried from {name}x0 to the last level."""
        out = []
        for k in range(levels):
            part = f"OVER (PARTITION BY g, pos // {FAN} ORDER BY pos ROWS BETWEEN"
            out.append(f"""{name}s{k} AS MATERIALIZED (SELECT g, pos, n, digest,
  coalesce(string_agg(digest, '') {part} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') {part} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT g, pos // {FAN} AS pos, (n + {FAN - 1}) // {FAN} AS n,
  CASE WHEN n > 1 THEN sha256(digest || r) ELSE digest END AS digest FROM {name}s{k} WHERE pos % {FAN} = 0)""")
            out.append(f"""{name}x{k + 1} AS MATERIALIZED (SELECT rid, x.g, x.pos // {FAN} AS pos,
  CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f, CASE WHEN n > 1 THEN p || l || r ELSE p END AS p
  FROM {name}x{k} x JOIN {name}s{k} s ON x.g IS NOT DISTINCT FROM s.g AND x.pos = s.pos)""")
        return out

    step = f"xor(c >> 8, {_crc_table()}[xor(c & 255, b) + 1])"
    crc = ("coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
           f"lambda x: ascii(x)::BIGINT)), lambda c, b: {step}), 4294967295), 0)")
    last, top = f"a{lang_levels}", f"b{root_levels}"
    return ",\n".join([
        f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang, {h('text')} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {h(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS claim FROM documents)""",
        """r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY lang) AS n FROM d)""",
        "a0 AS MATERIALIZED (SELECT lang AS g, pos, n, leaf AS digest FROM r)",
        "ax0 AS MATERIALIZED (SELECT rid, lang AS g, pos, coalesce(claim, leaf) AS f, '' AS p FROM r)",
        *tree("a", "lang", lang_levels),
        f"""o AS MATERIALIZED (SELECT g AS lang, digest AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos,
  count(*) OVER () AS n FROM {last})""",
        "b0 AS MATERIALIZED (SELECT 0 AS g, pos, n, subroot AS digest FROM o)",
        f"""bx0 AS MATERIALIZED (SELECT rid, 0 AS g, o.pos, f, p FROM ax{lang_levels} x
  JOIN o ON x.g IS NOT DISTINCT FROM o.lang)""",
        *tree("b", "0", root_levels)]) + f"""
SELECT r.doc_id, r.leaf, o.subroot, t.digest AS root, sha256(x.p) AS proof_sha256, x.f AS folded_root,
  x.f = t.digest AS verified
FROM r JOIN bx{root_levels} x ON r.rid = x.rid JOIN o ON r.lang IS NOT DISTINCT FROM o.lang JOIN {top} t ON t.g = x.g"""


ORACLE = _oracle()
