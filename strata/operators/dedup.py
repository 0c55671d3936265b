"""Latest-record deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per ``keys`` in ``order`` (ROW_NUMBER() ... = 1).

    Catalyst plans this as a partial WindowGroupLimit before the shuffle, so
    each map task forwards at most one row per key: a hot key is cut down
    before it reaches its reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_dd_rn", F.row_number().over(w))
            .filter(F.col("_dd_rn") == 1).drop("_dd_rn"))
