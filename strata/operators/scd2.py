"""Version end dates for slowly changing rows (type-2 history)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import next_in_sequence


def scd2_end_dates(df: DataFrame, key: str, start: str, tiebreak: list[Column],
                   end: str) -> DataFrame:
    """``end`` = day before the next version's start within ``key``; NULL for
    the current version.  Versions with equal starts are ordered by
    ``tiebreak`` (the later one then ends before it starts)."""
    out = next_in_sequence(df, key, [F.col(start).asc_nulls_first()] + tiebreak, [start],
                           prefix="_next_")
    return (out.withColumn(end, F.date_sub(F.col(f"_next_{start}").cast("date"), 1))
            .drop(f"_next_{start}"))
