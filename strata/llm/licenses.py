"""Licence scan by canonical digest lookup, in SQL functions.

A text's canonical form is lower case without copyright statements, punctuation
and line breaks (any run of blanks and line breaks is one space), one space
after every word, with equivalent spellings
(licence/license, -ise/-ize, whilst/while, copyright owner/holder, ...) made
equal by suffix rules.  Known licences are put through the same function, and
the digests are hash-joined: the whole text of a document against all known
texts, and each of its lines, which is how one-line notices occur.

Cases: null, empty or wordless texts and lines have no digest and match
nothing; a matching line counts each time it occurs; rows equal in id are
counted together; a null id is reported as such; a text of one line counts as
whole and as line; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, small, table
from strata.llm.license_texts import KNOWN

# A statement of who holds the copyright or reserves rights ends where a known
# licence opens on its line; one that begins a line takes the rest of it.  Then,
# on words each followed by one space, equivalent spellings (pattern,
# replacement).  Both sides of a comparison go through the same rules.
STATEMENT = r"(?:copyright(?:[^\p{L}\n]*[0-9(©]| by )|\(c\)[^\p{L}\n]*[0-9]|©|all rights reserved)"
OPENINGS = ("permission is hereby granted", "permission to use", "redistribution and use", "licensed under",
            "released under", "this software is provided", "this work is licensed", "this program is free software",
            "this library is free software", "this source code form is subject", "spdx-license-identifier",
            "everyone is permitted")
OPENED = STATEMENT + r"[^\n]*?(" + "|".join(OPENINGS) + ")"
COPYRIGHT = r"(^|\n)[^\p{L}\p{N}\n]*" + STATEMENT + r"[^\n]*"
MARKS = r"[^\p{L}\p{N}\n]+"
SPELLING = [
    (r"([iy])s(e|es|ed|ing|ation|ations) ", r"$1z$2 "),
    (r"([a-z][a-z][a-z])our(s|ed|ite|ites)? ", r"$1or$2 "),
    (r"enc(e|es|ed|ing) ", r"ens$1 "),
    (r"ll(ed|ing|ment)? ", r"l$1 "),
]
LITERAL = [
    ("dgement", "dgment"),
    ("ogue ", "og "),
    ("whilst ", "while "),
    ("entre ", "enter "),
    ("programme ", "program "),
    ("per cent ", "percent "),
    ("non commerc", "noncommerc"),
    ("sub licens", "sublicens"),
    ("copyright owner", "copyright holder"),
    ("artefact", "artifact"),
]


def canonical_lines(text: Column) -> Column:
    """Canonical text with a line break after every line."""
    t = F.lower(F.concat(F.coalesce(text, F.lit("")), F.lit("\n")))
    t = F.regexp_replace(t, OPENED, "$1")
    t = F.regexp_replace(t, COPYRIGHT, "$1")
    t = F.regexp_replace(t, MARKS, " ")
    t = F.regexp_replace(t, r" ?\n ?", " \n")
    for pattern, to in SPELLING:
        t = F.regexp_replace(t, pattern, to)
    for old, new in LITERAL:
        t = F.replace(t, F.lit(old), F.lit(new))
    return t


def _units(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep..., digest, whole) of the whole text and of every line."""
    canon = df.select(*keep, canonical_lines(F.col(text)).alias("_c"))
    whole = F.struct(F.regexp_replace(F.col("_c"), "[ \n]+", " ").alias("u"), F.lit(True).alias("w"))
    lines = F.transform(F.split("_c", "\n"), lambda u: F.struct(u.alias("u"), F.lit(False).alias("w")))
    # both from one canonical text: the rules run once
    each = canon.select(*keep, F.explode(F.concat(F.array(whole), lines)).alias("_x"))
    return (each.select(*keep, F.trim(F.col("_x.u")).alias("_u"), F.col("_x.w").alias("whole"))
            .filter("_u <> ''").select(*keep, F.md5("_u").alias("digest"), "whole"))


def known_digests(known: DataFrame) -> DataFrame:
    """(license_id, digest) of whole known texts."""
    return (_units(known, "text", ["license_id"]).filter("whole")
            .select("license_id", "digest").distinct())


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, license_id, in_whole, n_lines) of every licence of a document."""
    if known is None:
        known = docs.sparkSession.createDataFrame(KNOWN, "license_id string, text string")
    known = Scratch(docs.sparkSession, "licenses").write(known_digests(known))
    hits = _units(docs.select("doc_id", "text"), "text", ["doc_id"]).join(
        small(known, known.count(), 100), "digest")
    return hits.groupBy("doc_id", "license_id").agg(
        F.max("whole").alias("in_whole"),
        F.sum(F.when(F.col("whole"), 0).otherwise(1)).alias("n_lines"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def canon(col: str) -> str:
        t = f"lower(coalesce({col}, '') || chr(10))"
        for pattern, to in [(OPENED, "$1"), (COPYRIGHT, "$1"), (MARKS, " "), (r" ?\n ?", " \n"), *SPELLING]:
            to = to.replace("$", "\\").replace("'", "''")
            t = f"regexp_replace({t}, '{pattern}', {_lit(to)}, 'g')"
        for old, new in LITERAL:
            t = f"replace({t}, '{old}', '{new}')"
        return t

    def _lit(x: str) -> str:
        return " || chr(10) || ".join(f"'{p}'" for p in x.split("\n"))

    known = ", ".join(f"('{i}', {_lit(t.replace(chr(39), chr(39) * 2))})" for i, t in KNOWN)
    return f"""WITH k AS (SELECT * FROM (VALUES {known}) v(license_id, text)),
known AS (SELECT DISTINCT license_id, md5(trim(regexp_replace({canon("text")}, '[ \\n]+', ' ', 'g'))) AS digest
  FROM k),
c AS (SELECT doc_id, {canon("text")} AS t FROM documents),
u AS (SELECT doc_id, trim(regexp_replace(t, '[ \\n]+', ' ', 'g')) AS u, true AS whole FROM c
  UNION ALL SELECT doc_id, trim(unnest(string_split(t, chr(10)))) AS u, false AS whole FROM c)
SELECT doc_id, license_id, bool_or(whole) AS in_whole,
  sum(CASE WHEN whole THEN 0 ELSE 1 END)::BIGINT AS n_lines
FROM u JOIN known ON digest = md5(u) WHERE u <> '' GROUP BY doc_id, license_id"""


ORACLE = _oracle()
