"""Connected components of a link table, by repeated contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.frames import Scratch


def contract(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) of every node of ``links`` (columns a, b): label is one
    node of its component, the same for all of the component.

    A round points every node at its smallest neighbour (or itself), jumps
    once along the pointers and replaces the links' ends by what they point
    at, until no link joins two different nodes.  Aggregates combine before
    the shuffle and each round is written.  The joins on the pointers' targets
    bring all that point at one node into one task (Spark splits it only if it
    is large), so a node with very many links is a hot key there.
    """
    edges = scratch.write(links.select("a", "b").filter("a != b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = (both.groupBy("a").agg(F.min("b").alias("b"))
              .select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        jump = scratch.write(
            up.join(up.select(F.col("node").alias("to"), F.col("to").alias("to2")), "to", "left")
            .select("node", F.coalesce("to2", "to").alias("to")))
        moved = _relabel(_relabel(edges, "a", jump), "b", jump)
        left = scratch.write(moved.filter("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        found = jump.select("node", F.col("to").alias("label"))
        if labels is not None:
            found = _relabel(labels, "label", jump).unionByName(
                found.join(labels.select("node"), "node", "left_anti"))
        done = scratch.write(found)
        for old in (edges, jump, *([labels] if labels is not None else [])):
            scratch.drop(old)
        edges, labels = left, done
    scratch.drop(edges)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).filter("false")
    return labels


def _relabel(df: DataFrame, column: str, jump: DataFrame) -> DataFrame:
    """``column`` replaced by what it points at, if anything."""
    to = jump.select(F.col("node").alias(column), F.col("to").alias("_to"))
    return (df.join(to, column, "left")
            .withColumn(column, F.coalesce("_to", column)).drop("_to").select(*df.columns))
