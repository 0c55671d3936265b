"""Rows dealt into ranges, so that places and sums within a group come from
many tasks, however large the group is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.frames import Scratch


def deal(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` written in ascending order (nulls first) of group and order,
    with ``_part`` and ``_place``, which ascend alike."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    return scratch.write(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                         .withColumn("_part", F.spark_partition_id())
                         .withColumn("_place", F.monotonically_increasing_id()))


def runs(dealt: DataFrame, group: str, sums: dict[str, Column], **more: Column) -> DataFrame:
    """A row for each part that holds rows of a group: ``more``, aggregated,
    and of each of ``sums`` the group's total and what earlier parts hold
    (``total_x``, ``before_x``).  A window sees a row per part at most."""
    own = dealt.groupBy("_part", group).agg(
        *[F.sum(c).alias(f"_{k}") for k, c in sums.items()], *[c.alias(k) for k, c in more.items()])
    whole, before = Window.partitionBy(group), Window.partitionBy(group).orderBy("_part")
    for k in sums:
        own = own.withColumn(f"total_{k}", F.sum(f"_{k}").over(whole)) \
            .withColumn(f"before_{k}", F.sum(f"_{k}").over(before) - F.col(f"_{k}"))
    return own.drop(*[f"_{k}" for k in sums])
