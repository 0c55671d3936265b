"""Secret scan with multipart credential linking, in SQL functions only.

Base spans are the strong patterns (assign, access, hex).  Weak candidates
(an account name, a bare random-looking string, a service address) are common
in clean text; one is reported only when a complementary part begins within
``SCOPE`` characters of it: an identifier needs a secret, a secret an
identifier or an address, an address a secret.  The parts of all documents are
joined on (document, scope bin) as intervals, as a semi join, so no pairs are
made and a bin holds at most as many parts as it has characters.

Places come from pairing ``split`` (the text between matches) with
``regexp_extract_all`` (the matches) and adding up lengths in code points.

Cases: null text is empty (no spans, sha256 of nothing); repeated rows and
equal ids are reported each on its own; a null id is kept; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, table



def _any_case(*words: str) -> str:
    """The words in either case (A-Z only, in any regular expression dialect)."""
    each = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words]
    return "|".join(each)


# The base patterns, and the least length of what they match.
ASSIGN = (f"({_any_case('password', 'passwd', 'secret', 'token', 'api_?key')})"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 12
# Greedy runs: asking for the least length in the pattern finds the same spans
# as matching first and dropping short ones.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

# Weak candidates of the linking.
NAME = (f"(?:{_any_case('user(?:name)?', 'login', 'account', 'client_?id', 'access_?key(?:_?id)?')})"
        r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""")
RANDOM = r"[A-Za-z0-9+/_-]{24,}"
RANDOM_HAS = ("[0-9]", "[a-z]", "[A-Z]")  # all of them
ADDRESS = (f"(?:{_any_case('https?', 'wss?', 'ftps?', 's3', 'postgres(?:ql)?', 'mysql', 'mongodb', 'redis', 'amqp')})"
           r"""://[^\x00-\x20"'<>]+""")
SCOPE = 300
BLOCK = 256

# kind: (order, role).  Roles: i identifier, s secret, e endpoint.
KINDS = {"assign": (0, "s"), "access": (1, "i"), "hex": (2, "s"),
         "name": (3, "i"), "random": (4, "s"), "address": (5, "e")}
NEEDS = {"name": ("s",), "random": ("i", "e"), "address": ("s",)}


def _pieces(text: Column, pattern: str, ok=None) -> Column:
    """[(length before, length, passes)] of all matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    passes = ok or (lambda x: F.lit(True))
    return F.filter(F.zip_with(between, found, lambda p, x: F.struct(
        F.length(p).alias("gap"), F.length(x).alias("len"), passes(x).alias("ok"))),
        lambda x: x["len"].isNotNull())


def _blocks(pieces: Column) -> Column:
    """Matches in blocks: places within the block, and the block's length.

    Two levels keep the work linear in the matches of a very long text."""
    empty = F.expr("CAST(array() AS array<struct<s:int,e:int,ok:boolean>>)")

    def step(acc, x):
        s = acc["at"] + x["gap"]
        return F.struct((s + x["len"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), (s + x["len"]).alias("e"), x["ok"].alias("ok")))).alias("out"))

    cut = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int"))
    return F.transform(cut, lambda b: F.aggregate(
        F.slice(pieces, b * BLOCK + 1, BLOCK),
        F.struct(F.lit(0).alias("at"), empty.alias("out")), step))


def _spans(blocks: Column, kind: str) -> Column:
    """Spans (s, k, e) of all blocks that pass."""
    order = KINDS[kind][0]
    start = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.expr(
        "CAST(array() AS array<int>)").alias("all")), lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"),
            F.concat(acc["all"], F.array(acc["at"])).alias("all")))["all"]
    placed = F.flatten(F.zip_with(blocks, start, lambda b, at: F.transform(
        F.filter(b["out"], lambda x: x["ok"]), lambda x: F.struct(
            (x["s"] + at).alias("s"), F.lit(order).alias("k"), (x["e"] + at).alias("e")))))
    return placed


def _with_spans(df: DataFrame, text: str, patterns: dict) -> DataFrame:
    """Add an array column of spans for each kind; null where there is none."""
    for kind, (pattern, ok) in patterns.items():
        df = df.withColumn(f"{kind}_p", F.when(
            F.col(text).rlike(pattern), _pieces(F.col(text), pattern, ok)))
    df = df.drop(text)
    for kind in patterns:
        p = F.col(f"{kind}_p")
        df = df.withColumn(f"{kind}_b", F.when(F.size(p) > 0, _blocks(p))).drop(f"{kind}_p")
    none = F.expr("CAST(array() AS array<struct<s:int,k:int,e:int>>)")
    for kind in patterns:
        b = F.col(f"{kind}_b")
        df = df.withColumn(kind, F.coalesce(F.when(b.isNotNull(), _spans(b, kind)), none)) \
            .drop(f"{kind}_b")
    return df


PATTERNS = {
    "assign": (ASSIGN, lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= ASSIGN_MIN),
    "access": (ACCESS, None), "hex": (HEX, None),
    "name": (NAME, None),
    "random": (RANDOM, lambda x: x.rlike(RANDOM_HAS[0]) & x.rlike(RANDOM_HAS[1])
               & x.rlike(RANDOM_HAS[2])),
    "address": (ADDRESS, None),
}


def parts(docs: DataFrame) -> DataFrame:
    """(doc_id, h, an array of spans for each kind) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return _with_spans(docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("_t")),
                       "_t", PATTERNS)


def linked(found: DataFrame) -> DataFrame:
    """Weak spans with a complementary part in scope, by (doc_id, h): rows of
    one id and text are linked once, however many there are."""
    every = found.dropDuplicates(["doc_id", "h"]).select("doc_id", "h", F.explode(F.concat(*KINDS)).alias("x")).select(
        "doc_id", "h", F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"))
    names = list(KINDS)
    role = F.element_at(F.array(*[F.lit(KINDS[n][1]) for n in names]), F.col("k") + 1)
    weak = every.filter(F.col("k").isin([KINDS[n][0] for n in NEEDS])).select(
        F.col("doc_id").alias("d"), F.col("h").alias("g"), "s", "k", "e",
        F.explode(F.array(*[F.floor(F.col("s") / SCOPE) + i for i in (-1, 0, 1)])).alias("bin"))
    needs = F.lit(False)
    for n, roles in NEEDS.items():
        needs = needs | ((F.col("k") == KINDS[n][0]) & F.col("role").isin(*roles))
    other = every.select("doc_id", "h", F.col("s").alias("s2"), role.alias("role"),
                         F.floor(F.col("s") / SCOPE).alias("bin2"))
    held = weak.join(other, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("g") == F.col("h"))
                     & (F.col("bin") == F.col("bin2"))
                     & (F.abs(F.col("s") - F.col("s2")) <= SCOPE) & needs, "left_semi")
    return held.groupBy(F.col("d").alias("_d"), F.col("g").alias("_g")).agg(
        F.collect_set(F.struct("s", "k", "e")).alias("weak"))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of base spans, all spans."""
    found = Scratch(docs.sparkSession, "secrets").write(parts(docs))
    weak = linked(found)
    both = found.join(weak, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_g")),
                      "left")
    base = F.concat("assign", "access", "hex")
    none = F.expr("CAST(array() AS array<struct<s:int,k:int,e:int>>)")
    return both.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text(F.concat(base, F.coalesce("weak", none))).alias("spans"),
        F.size(F.coalesce("weak", none)).cast("long").alias("n_linked"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
