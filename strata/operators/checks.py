"""Generic data-quality operators (each returns the violating rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import skew


def check_unique(df: DataFrame, key: str, count_name: str = "row_count",
                 null_is_violation: bool = False) -> DataFrame:
    """Keys that occur more than once (and the NULL key, if asked).

    A grouped count with map-side partial aggregation: a hot key is summed
    per task before the shuffle.
    """
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    bad = F.col(count_name) > 1
    if null_is_violation:
        bad = bad | F.col(key).isNull()
    return g.filter(bad)


def not_trimmed(col: str) -> Column:
    """Value with leading or trailing spaces (NULL is not a violation)."""
    return F.col(col) != F.trim(F.col(col))


def check_trimmed(df: DataFrame, cols: list[str], out: list[str] | None = None) -> DataFrame:
    cond = reduce(lambda a, b: a | b, [not_trimmed(c) for c in cols])
    return df.filter(cond).select(*(out or cols))


def domain(df: DataFrame, col: str, ordered: bool = False) -> DataFrame:
    """Distinct values of a column (a standardisation listing)."""
    out = df.select(col).distinct()
    return out.orderBy(F.col(col).asc_nulls_first()) if ordered else out


def lookup(fact: DataFrame, dim: DataFrame, key: str, prefix: str,
           heavy: DataFrame | None = None) -> DataFrame:
    """``fact`` LEFT JOIN ``dim`` ON key, with dim columns renamed ``prefix + c``.

    Rows with a NULL key can never match, yet a shuffle join would send all
    of them to one reducer.  A salt is added as a second join key: a bucket
    hashed from the row's own columns for NULL-key rows, 0 for every other
    row and every dimension row.  Matches are unchanged and the NULL-key
    rows spread over all reducers, in one scan of the fact.  The salt is a
    pure function of the row, so a recomputed task sends every row where
    the first attempt did (no indeterminate shuffle); exact copies share a
    bucket, which AQE's skew-join split covers.  Keys of ``heavy`` (see
    ``operators.skew``) get as many salts as they need, and only their
    dimension rows are replicated.
    """
    # The dimension's salt must stay a real join key: a literal 0 would be
    # folded into a filter and the shuffle would hash on the key alone.
    d = dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns],
                   F.when(F.col(key).isNull(), -1).otherwise(0).alias("_lk_dsalt"))
    f, splits = fact, None
    if heavy is not None:
        d = skew.replicated(d.drop("_lk_dsalt"), prefix + key, heavy, "_lk_dsalt")
        f, splits = skew.with_splits(fact, key, heavy, "_lk_splits"), F.col("_lk_splits")
    f = f.withColumn("_lk_fsalt", skew.salt_of(key, fact.columns, splits, skew.partitions(fact)))
    cond = (F.col(key) == F.col(prefix + key)) & (F.col("_lk_fsalt") == F.col("_lk_dsalt"))
    return f.join(d, cond, "left").drop("_lk_fsalt", "_lk_dsalt", "_lk_splits")


def check_fk(fact: DataFrame, dims: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Fact rows with no match in at least one dimension.

    ``dims`` holds (dimension, key, prefix); the output carries the fact
    columns and every dimension column under its prefix.  Only keys are
    looked up for all rows; the attributes join the few rows that are left.
    """
    flagged, missing = fact, []
    for dim, key, _ in dims:
        probe = f"_fk_{len(missing)}_"
        flagged = lookup(flagged, dim.select(key), key, probe)
        missing.append(F.col(probe + key))
    bad = reduce(lambda a, b: a | b, [c.isNull() for c in missing])
    out = flagged.filter(bad).select(*fact.columns)
    for dim, key, prefix in dims:
        out = lookup(out, dim, key, prefix)
    return out


def profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, NULL cells, NULL share of cells and duplicate rows beyond the first.

    One grouped pass by a 64-bit hash of the row gives rows, NULL cells and
    the rows whose hash is their own (unique for certain); only hashes and
    partial counts move.  Rows that share a hash (copies, or the rare
    collision) are read again and get an exact ``distinct``.
    """
    n_cols = len(df.columns)
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    per_hash = df.select(row_hash.alias("_pf_h"), nulls.alias("_pf_x")).groupBy("_pf_h").agg(
        F.count(F.lit(1)).alias("_pf_n"), F.sum("_pf_x").alias("_pf_x"))
    stats = per_hash.agg(F.coalesce(F.sum("_pf_n"), F.lit(0)).alias("rows"),
                         F.coalesce(F.sum("_pf_x"), F.lit(0)).alias("null_cells"),
                         F.count_if(F.col("_pf_n") == 1).alias("unique_rows"))
    shared = df.withColumn("_pf_h", row_hash).join(
        per_hash.filter(F.col("_pf_n") > 1).select("_pf_h"), "_pf_h", "left_semi")
    distinct_shared = shared.drop("_pf_h").distinct().agg(F.count(F.lit(1))).scalar()
    cells = F.col("rows") * n_cols
    return stats.select(
        F.lit(table).alias("table_name"), F.col("rows").alias("row_count"), "null_cells",
        F.when(cells > 0, F.lit(100.0) * F.col("null_cells") / cells)
         .otherwise(F.lit(0.0)).alias("null_pct"),
        (F.col("rows") - F.col("unique_rows") - distinct_shared).alias("duplicates"))
