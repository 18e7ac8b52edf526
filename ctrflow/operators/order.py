"""Operations over one global order, without moving all rows to one task.

A window without ``partitionBy`` sends every row to a single task, and a window
partitioned by a skewed key does the same for that key. Here the rows are cut by
range into slices of about equal size, sorted and written to the shared folder
(``slice_in_order``). What crosses a slice boundary is one small row per slice and key:
the total of the earlier slices. That carry table has at most one row per slice
(only the key a slice starts with can have begun earlier), so broadcasting it is
bounded by the number of shuffle partitions, whatever the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.schema import as_columns
from ctrflow.scratch import local_table, materialize

SLICE = "__slice"
POS = "__pos"
_ROW = "__row"
_PART = "__part"
_POS_BITS = 33


def slice_in_order(df: DataFrame, order: Sequence[str | Column], unique: bool = False) -> DataFrame:
    """Write ``df`` in the given order; add the slice number and the position in it.

    Ties in ``order`` are broken by a hash of the whole row, and exact copies by the input
    partition they come from. So neither a hot order value nor a large group of
    copies has to fit one slice, and a task that is run again puts its rows in the
    same slices. Pass ``unique=True`` when the order is total already.
    """
    by = as_columns(order)
    placed = df
    if not unique:
        by = [*by, F.xxhash64(*df.columns), F.col(_PART)]
        placed = df.withColumn(_PART, F.spark_partition_id())
    placed = (
        placed.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*df.columns, F.monotonically_increasing_id().alias(_ROW))
    )
    # the id holds the partition number above bit 33 and the row number below
    return (
        materialize(placed, "ordered")
        .withColumn(SLICE, F.shiftright(_ROW, _POS_BITS))
        .withColumn(POS, F.col(_ROW).bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop(_ROW)
    )


def _in_slice(key: Sequence[str]) -> Window:
    return Window.partitionBy(SLICE, *key).orderBy(POS)


def _with_carry(sliced: DataFrame, key: Sequence[str], totals: list[Column], carry) -> DataFrame:
    """Join what earlier slices leave behind for each (slice, key).

    ``totals`` are aggregates per slice and key named ``__t*``; ``carry`` maps such a
    name and the window of earlier slices to the carried column.
    """
    per_slice = sliced.groupBy(SLICE, *key).agg(*totals)
    earlier = (
        Window.partitionBy(*key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    names = [c for c in per_slice.columns if c.startswith("__t")]
    carried = (
        per_slice.withColumn("__earlier", F.count(F.lit(1)).over(earlier))
        .select(SLICE, *key, "__earlier", *[carry(n, earlier).alias("__c" + n) for n in names])
        .where("__earlier > 0")
        .drop("__earlier")
    )
    if not key:
        return sliced.join(F.broadcast(carried), SLICE, "left")
    carried = carried.select(
        F.col(SLICE).alias("__cs"),
        *[F.col(k).alias("__ck" + k) for k in key],
        *["__c" + n for n in names],
    )
    same = F.col(SLICE) == F.col("__cs")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col("__ck" + k))
    return sliced.join(F.broadcast(carried), same, "left").drop("__cs", *["__ck" + k for k in key])


def dense_seq(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "seq",
    start: int = 1,
    unique: bool = False,
) -> DataFrame:
    """Number the rows consecutively in the given order.

    One range exchange; the second pass adds one offset per slice and has no window.
    """
    sliced = slice_in_order(df, order, unique)
    out = _with_carry(
        sliced, [], [F.count(F.lit(1)).alias("__tn")], lambda n, w: F.sum(n).over(w)
    )
    seq = F.coalesce(F.col("__c__tn"), F.lit(0)) + F.col(POS) + F.lit(start)
    return out.withColumn(name, seq.cast("bigint")).drop(SLICE, POS, "__c__tn")


def running_sums(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, Column],
    key: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Add, per output name, the running sum of a column in ``order`` within ``key``."""
    named = {f"__v{i}": (out, col) for i, (out, col) in enumerate(sums.items())}
    sliced = slice_in_order(
        df.withColumns({v: col for v, (_, col) in named.items()}), [*key, *order], unique
    )
    out = _with_carry(
        sliced,
        key,
        [F.sum(v).alias("__t" + v) for v in named],
        lambda n, w: F.sum(n).over(w),
    )
    local = _in_slice(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumns(
        {
            name: F.sum(v).over(local) + F.coalesce(F.col("__c__t" + v), F.lit(0))
            for v, (name, _) in named.items()
        }
    ).drop(SLICE, POS, *named, *["__c__t" + v for v in named])


def carry_last(
    df: DataFrame,
    col: str,
    order: Sequence[str],
    key: Sequence[str] = (),
    init: float | None = None,
    name: str = "carried",
    unique: bool = False,
) -> DataFrame:
    """Last non-null value of ``col`` up to each row; ``init`` before there is any."""
    sliced = slice_in_order(df, [*key, *order], unique)
    last_here = F.max_by(col, F.when(F.col(col).isNotNull(), F.col(POS)))
    out = _with_carry(
        sliced, key, [last_here.alias("__tl")], lambda n, w: F.last(n, ignorenulls=True).over(w)
    )
    local = _in_slice(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.coalesce(F.last(col, ignorenulls=True).over(local), F.col("__c__tl"))
    if init is not None:
        found = F.coalesce(found, F.lit(init))
    return out.withColumn(name, found).drop(SLICE, POS, "__c__tl")


def pick_ranks(
    sliced: DataFrame, value: str, count: str, key: str, ranks: dict[str, set[int]]
) -> DataFrame:
    """Values at given 0-based ranks of weighted values, per (string) key:
    ``(key, rank, value)``.

    ``sliced`` is one row per key and value with its number of occurrences, put in that order
    by ``slice_in_order``. The driver sees one row per slice and key it holds; only slices
    with a wanted rank are then looked at row by row.
    """
    spans = sliced.groupBy(key, SLICE).agg(F.sum(count).alias("n")).collect()
    end: dict[str, int] = {}
    wanted = []
    for name, number, n in sorted(r for r in spans if r[0] in ranks):
        start = end.get(name, 0)
        end[name] = start + n
        wanted += [(name, number, start, r) for r in ranks[name] if start <= r < start + n]
    places = local_table(
        sliced.sparkSession, "__k string, __s bigint, __start bigint, rank bigint", wanted
    )
    here = sorted({w[1] for w in wanted})
    local = _in_slice([key]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = sliced.where(F.col(SLICE).isin(here)).withColumn("__end", F.sum(count).over(local))
    at = F.col("rank") - F.col("__start")
    return ended.join(
        F.broadcast(places),
        (F.col(key) == F.col("__k"))
        & (F.col(SLICE) == F.col("__s"))
        & (at < F.col("__end"))
        & (at >= F.col("__end") - F.col(count)),
    ).select(key, "rank", F.col(value).alias("value"))
