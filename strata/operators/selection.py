"""Exact k-th rows of several orders by repeated histograms, without a sort.

To cut an order at given ranks only the rows at these ranks are needed.  A
histogram over the key's range tells in which bucket each rank lies; the next
pass spreads that bucket over a histogram of its own, until it holds few rows
or one key value.  Equal key values go on with the next part of the key, in the
same way.  A pass is one map-side combined count of at most ``BUCKETS`` groups
for each rank sought, for all orders together; what comes to the driver is
these counts, and at the end the rows found; a bucket of at most ``FETCH`` rows
is sorted in one task.  Rows that are equal in all integer parts and too many
for that are ranked by a distributed sort of these rows alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
FETCH = 1 << 16


@dataclass
class _Search:
    """One rank of one order: rows whose parts before ``at`` equal ``fixed``
    and whose part ``at`` lies in low .. high; ``rank`` counts from 0 in them."""
    order: int
    rank: int
    rows: int
    low: int
    high: int
    at: int = 0
    fixed: tuple[int, ...] = ()

    def holds(self, parts: list[Column]) -> Column:
        out = parts[self.at].between(F.lit(self.low), F.lit(self.high))
        for value, part in zip(self.fixed, parts):
            out = out & (part == F.lit(value))
        return out

    def narrow(self, ends: dict[tuple[int, int], tuple[int, int]]) -> None:
        """Go on to the next part while this one has a single value."""
        while self.low == self.high and (self.order, self.at + 1) in ends:
            self.fixed, self.at = (*self.fixed, self.low), self.at + 1
            self.low, self.high = ends[self.order, self.at]

    def width(self) -> int:
        return -(-(self.high - self.low + 1) // BUCKETS)


def kth_rows(df: DataFrame, orders: list[list[Column]], rest: list[str],
             ranks: Callable[[int], list[int]],
             row: list[Column], fetch: int = FETCH) -> list[list]:
    """For each order the rows at ``ranks`` of the row count (from 1, ascending).

    ``orders``: lists of integer parts, never NULL, compared one after the
    other; ``rest``: columns that follow them in every order, NULLs first, and
    make it total.  ``row``: what is returned of each row found.
    """
    parts = list({id(p): p for own in orders for p in own}.values())  # orders share their last ones
    bounds = df.agg(F.count(F.lit(1)).alias("n"), *[
        f(p).alias(f"{name}{id(p)}") for p in parts for name, f in (("min", F.min), ("max", F.max))]).first()
    ends = {(i, j): (bounds[f"min{id(p)}"], bounds[f"max{id(p)}"])
            for i, own in enumerate(orders) for j, p in enumerate(own)}
    n = bounds["n"]
    searches = [_Search(i, rank - 1, n, *ends[i, 0]) for i in range(len(orders)) for rank in ranks(n)]
    for s in searches:
        s.narrow(ends)
    open_ = [s for s in searches if s.rows > fetch and s.low < s.high]
    while open_:
        counts = _histograms(df, orders, open_)
        for s in open_:
            width, before = s.width(), 0
            for bucket, n in sorted(counts[id(s)].items()):
                if s.rank < before + n:
                    break
                before += n
            s.rank, s.rows = s.rank - before, n
            s.low, s.high = s.low + bucket * width, min(s.low + (bucket + 1) * width - 1, s.high)
            s.narrow(ends)
        open_ = [s for s in open_ if s.rows > fetch and s.low < s.high]
    return _fetched(df, orders, rest, searches, row, fetch)


def _histograms(df: DataFrame, orders: list[list[Column]], searches: list[_Search]) -> dict[int, dict[int, int]]:
    """Rows per bucket of each search; equal searches are counted once."""
    same: dict[tuple, list[_Search]] = {}
    for s in searches:
        same.setdefault((s.order, s.at, s.fixed, s.low, s.high), []).append(s)
    hit = []
    for k, own in enumerate(same.values()):
        s, parts = own[0], orders[own[0].order]
        bucket = F.call_function("div", parts[s.at] - F.lit(s.low), F.lit(s.width()))
        hit.append(F.when(s.holds(parts), F.struct(F.lit(k).alias("s"), bucket.cast("long").alias("b"))))
    found = (df.select(F.explode(F.array_compact(F.array(*hit))).alias("x"))
             .groupBy("x.s", "x.b").agg(F.count(F.lit(1)).alias("n")).collect())
    out: dict[int, dict[int, int]] = {id(s): {} for s in searches}
    groups = list(same.values())
    for r in found:
        for s in groups[r["s"]]:
            out[id(s)][r["b"]] = r["n"]
    return out


def _fetched(df: DataFrame, orders: list[list[Column]], rest: list[str], searches: list[_Search],
             row: list[Column], fetch: int) -> list[list]:
    """The row at the rank of each search: a group of few rows is sorted in its
    task, and the rows at the ranks sought come to the driver."""
    keys: dict[tuple, list[_Search]] = {}
    for s in searches:
        if s.rows <= fetch:
            keys.setdefault((s.order, s.at, s.fixed, s.low, s.high), []).append(s)
    groups = list(keys.values())
    found: dict[int, object] = {}
    if groups:
        hit = [F.when(own[0].holds(orders[own[0].order]), F.struct(
            F.lit(k).alias("s"), F.array(*orders[own[0].order]).alias("k"))) for k, own in enumerate(groups)]
        rows = df.select(F.explode(F.array_compact(F.array(*hit))).alias("x"), F.struct(*rest).alias("t") if rest
                         else F.lit(0).alias("t"), F.struct(*row).alias("r"))
        ranks = F.array(*[F.array(*[F.lit(s.rank) for s in own]) for own in groups])
        held = rows.groupBy("x.s").agg(F.array_sort(F.collect_list(F.struct("x.k", "t", "r"))).alias("g"))
        for r in held.select("s", F.transform(F.get(ranks, F.col("s")), lambda i: F.get(F.col("g.r"), i))
                             .alias("r")).collect():
            for s, got in zip(groups[r["s"]], r["r"]):
                found[id(s)] = got
    for s in searches:
        if id(s) not in found:  # many rows, equal in all integer parts
            from strata.operators.ranking import global_row_number
            same = df.filter(s.holds(orders[s.order])).select(*rest, F.struct(*row).alias("_r"))
            ranked = global_row_number(same, [F.col(c).asc_nulls_first() for c in rest], out="_n", name="kth")
            found[id(s)] = ranked.filter(F.col("_n") == s.rank + 1).first()["_r"]
    out: list[list] = [[] for _ in orders]
    for s in searches:
        out[s.order].append(found[id(s)])
    return out
