"""Global ranking without a single-partition window.

``ROW_NUMBER() / NTILE(n) / RANK() OVER (ORDER BY ...)`` with no PARTITION
BY makes Spark move every row to one task.  Here the order is split into
contiguous ranges instead:

1. ``repartitionByRange`` on the full sort key (Spark samples the key, so a
   hot leading value is split by the next key) and a sort inside each range;
2. each row is tagged with its range id and position, and the tagged rows
   are written to the shared checkpoint folder (a durable lineage cut, so a
   lost executor can never renumber rows);
3. rows per range -> running offsets on a table with one row per range
   (its size is the partition count, so broadcasting it is bounded);
4. rank = offset + position + 1.

Callers pass a sort key that is unique (add tie-breakers); RANK is built on
top by taking the first row number of each group of equal keys.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.selection import kth_rows
from strata.session import checkpoint_root, partitions
from strata.sources.store import delete_folder, materialize

_PART, _MID, _OFF, _TOTAL = "_rk_part", "_rk_mid", "_rk_off", "_rk_total"

_FOLDER: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def scratch_root(spark) -> str:
    """This application's folder for ranking intermediates."""
    return f"{checkpoint_root(spark)}/strata/_work/{spark.sparkContext.applicationId}"


@contextlib.contextmanager
def scratch_of(spark):
    """Intermediates made inside go to a folder that is deleted at the end.

    For builds whose result is written inside: nothing refers to the
    intermediates afterwards.
    """
    folder = f"{scratch_root(spark)}/build-{uuid.uuid4().hex[:12]}"
    token = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        delete_folder(spark, folder)


def _scratch(df: DataFrame, name: str) -> str:
    folder = _FOLDER.get() or scratch_root(df.sparkSession)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def global_row_number(df: DataFrame, order: list[Column], out: str = "rn",
                      num_ranges: int | None = None, keep_total: bool = False,
                      name: str = "rownum") -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (bigint).

    Without ``num_ranges`` the range count starts at the shuffle partition
    number and AQE coalesces *adjacent* ranges to its advisory size, which
    keeps the global order (coalesced range i still precedes range i + 1).
    """
    ranged = (df.repartitionByRange(num_ranges, *order) if num_ranges
              else df.repartitionByRange(*order))
    tagged = (ranged.sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().alias(_PART),
                      F.monotonically_increasing_id().alias(_MID)))
    tagged = materialize(tagged, _scratch(df, name))

    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PART,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF),
        F.sum("_n").over(Window.partitionBy()).alias(_TOTAL),
    )
    position = F.col(_MID) - F.shiftleft(F.col(_PART).cast("long"), 33)
    ranked = (tagged.join(F.broadcast(offsets), _PART)
              .withColumn(out, (F.col(_OFF) + position + 1).cast("long")))
    drop = [_PART, _MID, _OFF] + ([] if keep_total else [_TOTAL])
    return ranked.drop(*drop)


def surrogate_key(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) as a distributed surrogate key."""
    return global_row_number(df, order, out=out, name=f"sk_{out}")


def global_ntile(df: DataFrame, tiles: int, order: list[Column], out: str) -> DataFrame:
    """NTILE(tiles) OVER (ORDER BY order): the first N mod tiles groups get one extra row."""
    ranked = global_row_number(df, order, out="_nt_rn", keep_total=True, name=f"ntile_{out}")
    rn, total = F.col("_nt_rn"), F.col(_TOTAL)
    q = F.call_function("div", total, F.lit(tiles))
    r = total % tiles
    big = r * (q + 1)
    tile = (F.when(rn <= big, F.call_function("div", rn - 1, q + 1) + 1)
            .otherwise(r + F.call_function("div", rn - 1 - big, F.nullif(q, F.lit(0))) + 1))
    return ranked.withColumn(out, tile.cast("long")).drop("_nt_rn", _TOTAL)


def _chunked(ranked: DataFrame, rn: str, rows: int | None = None) -> DataFrame:
    """Add ``_ck``: runs of consecutive row numbers, as many as the session has
    shuffle partitions (or of ``rows`` each), so windows over a run are even,
    and a table of one row per run is bounded by the partition count."""
    runs = partitions(ranked.sparkSession)
    size = F.lit(rows) if rows else F.greatest(
        F.call_function("div", F.col(_TOTAL) + (runs - 1), F.lit(runs)), F.lit(1))
    return ranked.withColumn("_ck", F.call_function("div", F.col(rn) - 1, size)).drop(_TOTAL)


def global_rank(df: DataFrame, keys: list[str], ascending: list[bool],
                tiebreak: list[Column], out: str) -> DataFrame:
    """RANK() OVER (ORDER BY keys): 1 + rows strictly before, ties share a rank.

    Row numbers use ``keys`` + ``tiebreak`` so a hot key value is still split
    across ranges.  The rank of a group of equal keys is its smallest row
    number: taken inside runs of consecutive row numbers, and for the groups
    at a run's two ends from a small table of those ends (a group that spans
    runs touches an end in each of them).
    """
    order = [(F.col(k).asc_nulls_first() if a else F.col(k).desc_nulls_last())
             for k, a in zip(keys, ascending)]
    ranked = _chunked(global_row_number(df, order + tiebreak, out="_rk_rn", keep_total=True,
                                        name=f"rank_{out}"), "_rk_rn")
    group = F.struct(*[F.col(k) for k in keys])
    run = Window.partitionBy("_ck").orderBy("_rk_rn")
    same = Window.partitionBy("_ck", *keys)
    local = ranked.withColumn("_rk_lo", F.min("_rk_rn").over(same))
    local = materialize(local.withColumn("_rk_last", F.lead("_rk_rn").over(run).isNull())
                        .withColumn("_rk_first", F.lag("_rk_rn").over(run).isNull()),
                        _scratch(df, f"rank_{out}"))
    # at most two rows per run
    ends = (local.filter("_rk_last or _rk_first").groupBy(group.alias("_rk_k"))
            .agg(F.min("_rk_lo").alias("_rk_start")))
    joined = local.join(F.broadcast(ends), group.eqNullSafe(F.col("_rk_k")), "left")
    return (joined.withColumn(out, F.coalesce("_rk_start", "_rk_lo"))
            .drop("_rk_rn", "_ck", "_rk_lo", "_rk_last", "_rk_first", "_rk_k", "_rk_start"))


def next_in_sequence(df: DataFrame, group: str, order: list[Column], cols: list[str],
                     prefix: str = "next_", chunk_rows: int | None = None) -> DataFrame:
    """LEAD(col) OVER (PARTITION BY group ORDER BY order) for each of ``cols``.

    Rows get global row numbers over (group, order), so one huge group never
    lands in a single task.  LEAD is then taken inside runs of consecutive row
    numbers (one shuffle on the run; runs are even and as many as the shuffle
    partitions).  Only the last row of a run needs the first row of the next
    one; those firsts are one row per run, broadcast to patch them.
    """
    seq = _chunked(global_row_number(df, [F.col(group).asc_nulls_first()] + order, out="_nx_rn",
                                     keep_total=True, name="lead"), "_nx_rn", chunk_rows)
    w = Window.partitionBy("_ck").orderBy("_nx_rn")
    within = seq.select("*", F.lead("_nx_rn").over(w).isNull().alias("_nx_last"),
                        F.lead(group).over(w).alias("_nx_group"),
                        *[F.lead(c).over(w).alias(f"_nx_{c}") for c in cols])
    first = F.min(F.struct("_nx_rn", group, *cols))
    firsts = seq.groupBy("_ck").agg(first.alias("_nx_f")).select(
        (F.col("_ck") - 1).alias("_nx_prev"), F.col(f"_nx_f.{group}").alias("_nx_pgroup"),
        *[F.col(f"_nx_f.{c}").alias(f"_nx_p{c}") for c in cols])
    joined = within.join(F.broadcast(firsts),
                         (F.col("_ck") == F.col("_nx_prev")) & F.col("_nx_last"), "left")
    last = F.col("_nx_last")
    nxt_group = F.when(last, F.col("_nx_pgroup")).otherwise(F.col("_nx_group"))
    # the very last row of all has no next row, even within a NULL group
    exists = ~last | F.col("_nx_prev").isNotNull()
    same = exists & nxt_group.eqNullSafe(F.col(group))
    for c in cols:
        nxt = F.when(last, F.col(f"_nx_p{c}")).otherwise(F.col(f"_nx_{c}"))
        joined = joined.withColumn(f"{prefix}{c}", F.when(same, nxt))
    return joined.drop("_nx_rn", "_ck", "_nx_last", "_nx_group", "_nx_prev", "_nx_pgroup",
                       *[f"_nx_{c}" for c in cols], *[f"_nx_p{c}" for c in cols])


def multi_ntile(df: DataFrame, tiles: int, keys: dict[str, tuple[str, bool]],
                unique: list[str]) -> DataFrame:
    """Several NTILE(tiles) columns over integer keys without any sort.

    ``keys`` maps an output name to (integer column, ascending); ascending
    puts NULLs first, descending puts them last.  ``unique`` is a key of
    ``df`` and breaks ties in every order; its integer columns come first.  A
    tile needs no row's rank: the rows at the ``tiles - 1`` cuts of each order
    (found by histograms, see ``selection``) tell every row its tile by
    comparison, without a join.
    """
    wide = ("tinyint", "smallint", "int", "bigint")
    kinds = dict(df.dtypes)
    whole = [u for u in unique if kinds[u] in wide]
    rest = [u for u in unique if kinds[u] not in wide]
    ids = [_not_null(F.col(u).cast("long"), True) for u in whole]
    orders = [[*_not_null(F.col(c).cast("long") if up else -F.col(c).cast("long"), up), *sum(ids, [])]
              for c, up in keys.values()]

    def ends(n: int) -> list[int]:
        q, r = divmod(n, tiles)
        last = [q * i + min(r, i) for i in range(1, tiles)]
        return [k for k in last if 0 < k < n]

    cuts = kth_rows(df, orders, rest, ends, [
        F.struct(*[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(keys.values())]).alias("keys"),
        F.struct(*[F.col(u) for u in (*whole, *rest)]).alias("unique")])

    def place(c: Column, up: bool, tie: list[Column]) -> Column:
        flag, k = _not_null(c if up else -c, up)
        return F.struct(flag.alias("f"), k.alias("k"), *[t.alias(f"t{j}") for j, t in enumerate(tie)])

    scored = df
    ties = [F.col(u) for u in (*whole, *rest)]
    for i, (name, (c, up)) in enumerate(keys.items()):
        own, tile = place(F.col(c).cast("long"), up, ties), F.lit(1)
        for row in cuts[i]:
            at = place(F.lit(row["keys"][i]).cast("long"), up,
                       [F.lit(row["unique"][u]).cast(kinds[u]) for u in (*whole, *rest)])
            tile = tile + (own > at).cast("long")
        scored = scored.withColumn(name, tile.cast("long"))
    return scored.select(*df.columns, *keys)


def _not_null(c: Column, first: bool) -> list[Column]:
    """A nullable integer as two that are not: NULLs first, or last."""
    flag = F.when(c.isNull(), 0 if first else 1).otherwise(1 if first else 0)
    return [flag.cast("long"), F.coalesce(c, F.lit(0).cast("long"))]
