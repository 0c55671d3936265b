"""Training-data pipeline over ``documents``: five stages, each over all that
the one before kept, written as Parquet in the shared folder and reread.

1. language: rows whose text is null or has no letter go;
2. near-duplicates: one row of each group stays (5-word shingles, similarity
   of 0.8 or more);
3. decontamination: rows hit by a 10-word window of ``benchmark`` go;
4. mixing: rows are sampled by probabilities fitted to source, language and
   topic targets that add up to ``KEEP`` of all words;
5. token file: the ids of what is left are bit-packed and written in document
   order; the rows are the digests read back from the files.

Stages 1 to 4 return the columns of their input unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, language, mixing, neardup, tokenfile
from strata.llm.frames import Scratch, table

KEEP = 0.6  # share of the words that mixing keeps


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, 5, 80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, keep=KEEP)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenfile.encode(docs)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix_sources", mixed),
    ("token_file", token_file),
]

# Language ID, MinHash and subword encoding cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
