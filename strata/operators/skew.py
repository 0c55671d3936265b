"""Heavy keys: found by a sketch, split by a salt; their partners replicated.

A key is heavy if it holds more than a quarter of an average partition.  One
pass over the key column fills a frequent-items sketch, whose size depends on
the partition count alone; at most ``SHARE`` keys per partition can be heavy,
so the table of heavy keys is bounded by the partition count as well.  Rows of
a heavy key get a salt, hashed from the row, of as many values as the key needs;
the other side's row is replicated for just these values.  All other keys have
salt 0 and are not replicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import session

SHARE = 4            # a key with more than 1/SHARE of a partition's rows is heavy
SKETCH_KEYS = 10000  # the sketch reports this many keys at most
SKETCH_ROOM = 64     # items that the sketch tracks for each heavy key there can be


def partitions(df: DataFrame) -> int:
    return session.partitions(df.sparkSession)


def heavy_keys(df: DataFrame, keys: list[str], parts: int | None = None) -> dict[str, DataFrame | None]:
    """For each key column a table (key, splits) of its heavy keys, or None.

    One job for all columns; NULL is no key.  Counts are the sketch's
    estimates: a light key taken for heavy costs a few replicated rows.
    """
    parts = parts or partitions(df)
    most = min(SHARE * parts, SKETCH_KEYS)
    room = min(max(SKETCH_ROOM * most, 1024), 1_000_000)
    got = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"approx_top_k(`{k}`, {most}, {room})").alias(f"k{i}") for i, k in enumerate(keys)]).first()
    portion = max(got["n"] / (SHARE * parts), 1)  # rows of one split
    out: dict[str, DataFrame | None] = {}
    for i, k in enumerate(keys):
        found = [(r["item"], -int(-r["count"] // portion)) for r in got[f"k{i}"] or []
                 if r["item"] is not None and r["count"] > portion]
        kind = df.schema[k].dataType.simpleString()
        out[k] = df.sparkSession.createDataFrame(found, f"`{k}` {kind}, splits int") if found else None
    return out


def salt_of(key: str, row: list[str], splits: Column | None, parts: int) -> Column:
    """The salt of a row: 0 unless its key is heavy (``splits``) or NULL, which
    matches nothing and is dealt over all partitions.  A pure function of the
    row, so a recomputed task sends every row where the first attempt did."""
    h = F.xxhash64(*[F.col(c) for c in row])
    salt = F.when(F.col(key).isNull(), F.pmod(h, F.lit(parts)))
    if splits is not None:
        salt = salt.when(splits > 1, F.pmod(h, splits))
    return salt.otherwise(0).cast("int")


def with_splits(df: DataFrame, key: str, heavy: DataFrame | None, out: str = "_splits") -> DataFrame:
    """``df`` with the number of salts of its key (1 if it is not heavy)."""
    if heavy is None:
        return df.withColumn(out, F.lit(1))
    h = heavy.select(F.col(heavy.columns[0]).alias("_hk"), F.col("splits").alias("_hs"))
    return (df.join(F.broadcast(h), F.col(key) == F.col("_hk"), "left")  # SHARE rows per partition at most
            .withColumn(out, F.coalesce("_hs", F.lit(1))).drop("_hk", "_hs"))


def replicated(dim: DataFrame, key: str, heavy: DataFrame | None, out: str) -> DataFrame:
    """``dim`` with a row for every salt that rows of its key can have."""
    wide = with_splits(dim, key, heavy)
    return wide.withColumn(out, F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))).drop("_splits")
