"""Feature statistics of a dataset.

Scalars of all columns come from one aggregation, histograms from one more scan and exact
quantiles from two. What depends on distinct strings (unique counts, top values, ranks) comes
from one table of value counts, in which a hot value is a single row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.operators.order import pick_ranks, slice_in_order
from ctrflow.scratch import local_table, materialize


#: Types of the nested parts of a statistics record.
NUM = (
    "struct<min:double,max:double,mean:double,std:double,zeros:bigint,median:double,"
    "std_hist:array<struct<lo:double,hi:double,count:double>>,quantiles:array<double>>"
)
STR = "struct<n_unique:bigint,avg_len:double,top:array<struct<value:string,count:bigint>>>"


def column_kind(dtype: T.DataType) -> str:
    """``numeric`` or ``string``."""
    return "numeric" if isinstance(dtype, T.NumericType) else "string"


def split_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    wanted = set(columns or df.columns)
    fields = [f for f in df.schema if f.name in wanted]
    numeric = [f.name for f in fields if column_kind(f.dataType) == "numeric"]
    return numeric, [f.name for f in fields if f.name not in numeric]


def _present(df: DataFrame, name: str) -> Column:
    """The column with NaN taken as missing."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


Measures = dict[str, tuple]


def _per_feature(df: DataFrame, columns: Sequence[str], measures: Measures) -> DataFrame:
    """One aggregation over all columns, returned as one row per feature.

    ``measures`` maps an output name to ``(column name -> aggregate, type)``.
    """
    aggs = [
        make(c).cast(t).alias(f"{m}__{i}")
        for i, c in enumerate(columns)
        for m, (make, t) in measures.items()
    ]
    structs = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}__{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("f")).select("f.*")


def _common(df: DataFrame) -> Measures:
    return {
        "n_rows": (lambda c: F.count(F.lit(1)), "bigint"),
        "n_present": (lambda c: F.count(_present(df, c)), "bigint"),
    }


def _numeric(df: DataFrame) -> Measures:
    def num(c):
        return _present(df, c).cast("double")

    return {
        "min": (lambda c: F.min(num(c)), "double"),
        "max": (lambda c: F.max(num(c)), "double"),
        "mean": (lambda c: F.avg(num(c)), "double"),
        "std": (lambda c: F.stddev_pop(num(c)), "double"),
        "zeros": (lambda c: F.count(F.when(num(c) == 0, 1)), "bigint"),
    }


def _with_presence(common: DataFrame) -> DataFrame:
    return common.withColumn("n_missing", F.col("n_rows") - F.col("n_present")).withColumn(
        "presence", F.when(F.col("n_rows") > 0, F.col("n_present") / F.col("n_rows"))
    )


def stats_common(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, non-missing, missing and presence per feature."""
    return _with_presence(_per_feature(df, list(columns or df.columns), _common(df)))


def numeric_scalars(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, mean, population deviation and zeros per feature."""
    return _per_feature(df, columns, _numeric(df))


def string_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, count)`` with values as text."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


#: Rank error of the sketches, as a share of the rows, is at most one in ACCURACY.
ACCURACY = 10_000


def _sketch(df: DataFrame, columns: Sequence[str], probs: list[float]) -> dict[str, tuple]:
    """``feature -> (rows, approximate quantiles)``; a few numbers per column."""
    aggs = []
    for i, c in enumerate(columns):
        value = _present(df, c).cast("double")
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.percentile_approx(value, probs, ACCURACY).alias(f"v{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"v{i}"]) for i, c in enumerate(columns) if row[f"n{i}"]}


def _count_cells(names: list[str], limits: dict, bins: int, side: str | None):
    """Counts of numbers per task: of bins and gaps once, of values inside a bracket per batch, so little is held."""
    at = {
        key: (low, high, np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
        for key, (low, high, spans) in limits.items()
    }

    def bins_of(x: np.ndarray, low: float, high: float) -> np.ndarray:
        # as bin_of
        if high <= low:
            return np.zeros(len(x), np.int64)
        with np.errstate(all="ignore"):
            inner = np.nan_to_num(np.floor((x - low) / (high - low) * bins), nan=0.0)
        return np.where(x <= low, 0, np.where(x >= high, bins - 1, np.minimum(inner, bins - 1))).astype(np.int64)

    def rows(key: tuple, bin: list, region: list, value: list, count: np.ndarray) -> pa.RecordBatch:
        n = len(count)
        return pa.RecordBatch.from_pydict({
            "side": pa.array([key[0]] * n, pa.string()), "feature": pa.array([key[1]] * n, pa.string()),
            "bin": pa.array(bin, pa.int32()), "region": pa.array(region, pa.int32()),
            "value": pa.array(value, pa.float64()), "count": pa.array(count, pa.int64()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {key: (np.zeros(bins, np.int64), np.zeros(2 * len(a) + 1, np.int64)) for key, (_, _, a, _) in at.items()}
        for batch in batches:
            parts = [(None, batch)]
            if side:
                parts = [(v.as_py(), batch.filter(pc.equal(batch.column(side), v))) for v in pc.unique(batch.column(side))]
            for part, mine in parts:
                for i, name in enumerate(names):
                    key = (part, name)
                    if key not in at:
                        continue
                    low, high, opens, ends = at[key]
                    x = mine.column(f"__x{i}").drop_null().to_numpy(zero_copy_only=False)
                    if low is not None:
                        held[key][0][:] += np.bincount(bins_of(x, low, high), minlength=bins)
                    # edges passed: even in a gap, odd inside a bracket
                    passed = np.searchsorted(opens, x, "right") + np.searchsorted(ends, x, "left")
                    inside = passed % 2 == 1
                    held[key][1][:] += np.bincount(passed[~inside], minlength=len(held[key][1]))
                    values, first, n = np.unique(x[inside], return_index=True, return_counts=True)
                    if len(n):
                        yield rows(key, [None] * len(n), passed[inside][first], values, n)
        for key, (binned, gaps) in held.items():
            for counts, is_bin in ((binned, True), (gaps, False)):
                found = np.flatnonzero(counts)
                none = [None] * len(found)
                yield rows(key, found if is_bin else none, none if is_bin else found, none, counts[found])

    return run


def _number_cells(df: DataFrame, limits: dict, bins: int = 0, by: str | None = None) -> DataFrame:
    """``(side, feature, bin, region, value, count)``: counts of each task, still to be summed.

    ``limits`` has, per side (a string; None without ``by``) and numeric feature, ``(low, high, brackets)``. A number is counted in
    its bin, where there are limits, and once more by its region, with its value if that is a bracket. NumPy looks the edges up: as
    expressions they are too much code for the JVM to compile.
    """
    names = sorted({f for _, f in limits})
    side = [F.col(by).alias("__by")] if by else []
    # -0.0 is 0.0
    numbers = [(_present(df, c).cast("double") + F.lit(0.0)).alias(f"__x{i}") for i, c in enumerate(names)]
    return df.select(*side, *numbers).mapInArrow(
        _count_cells(names, limits, bins, "__by" if by else None),
        "side string, feature string, bin int, region int, value double, count bigint",
    )


def _pick(df: DataFrame, brackets: dict[str, list[tuple]], ranks: dict[str, set[int]]) -> dict:
    """``(feature, rank) -> value``, None for a rank outside its feature's brackets.

    A value inside a bracket is counted by itself, all others by the gap they lie in. Ordered by
    region and value these counts are a feature's whole distribution, of which only
    the part inside the brackets is shuffled value by value.
    """
    limits = {(None, feature): (None, None, spans) for feature, spans in brackets.items()}
    counts = _number_cells(df, limits).groupBy("feature", "region", "value").agg(F.sum("count").alias("count"))
    sliced = slice_in_order(counts, ["feature", "region", "value"], unique=True)
    found = pick_ranks(sliced, "value", "count", "feature", ranks)
    return {(r.feature, r.rank): r.value for r in found.collect()}


def _merged(spans: list[tuple]) -> list[tuple]:
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def quantiles(
    df: DataFrame, columns: Sequence[str], parts: int = 10, sketch: bool = False
) -> DataFrame:
    """``parts + 1`` quantiles per feature as ``(feature, q, value)``, q = 0..parts.

    Exact, with linear interpolation between neighbours, in two scans. The first sketches
    each distribution and yields, for every wanted rank, a bracket of values that holds
    it; the second counts what lies outside the brackets and orders what lies inside, a few
    thousandths of the rows. Should a bracket miss its rank, all values are ordered.
    ``sketch=True`` stops after the first scan.
    """
    spark = df.sparkSession
    grid = [q / parts for q in range(parts + 1)]
    schema = "feature string, q int, value double"
    if sketch:
        found = _sketch(df, columns, grid)
        rows = [(f, q, v) for f, (_, values) in found.items() for q, v in enumerate(values)]
        return local_table(spark, schema, rows)
    margin = 2 / ACCURACY
    probs = [max(0.0, p - margin) for p in grid] + [min(1.0, p + margin) for p in grid]
    brackets, ranks, at = {}, {}, {}
    for feature, (n, values) in _sketch(df, columns, probs).items():
        lows, highs = values[: parts + 1], values[parts + 1 :]
        lows[0], highs[-1] = float("-inf"), float("inf")
        brackets[feature] = _merged(list(zip(lows, highs)))
        for q in range(parts + 1):
            below, rest = divmod(q * (n - 1), parts)
            at[feature, q] = (below, rest / parts)
            ranks.setdefault(feature, set()).update({below, below + 1} if rest else {below})
    if not ranks:
        return local_table(spark, schema, [])
    found = _pick(df, brackets, ranks)
    missed = {f for (f, _), v in found.items() if v is None}
    if missed:
        everything = {f: [(float("-inf"), float("inf"))] for f in missed}
        found.update(_pick(df, everything, {f: ranks[f] for f in missed}))
    rows = []
    for (feature, q), (below, part) in at.items():
        low = found[feature, below]
        step = (found[feature, below + 1] - low) * part if part else 0.0
        rows.append((feature, q, low + step))
    return local_table(spark, schema, rows)


def stats_numeric(df: DataFrame, columns: Sequence[str], sketch: bool = False) -> DataFrame:
    """Scalars and median per numeric feature."""
    median = quantiles(df, columns, 2, sketch=sketch).where("q = 1")
    return numeric_scalars(df, columns).join(
        median.select("feature", F.col("value").alias("median")), "feature", "left"
    )


def bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of a value; the last one is closed, and all is bin 0 if lo = hi.

    Values outside, infinite ones too, are in the first or last bin.
    """
    last = F.lit(bins - 1)
    inner = F.least(last, F.floor((value - lo) / (hi - lo) * bins))
    return F.when((hi <= lo) | (value <= lo), F.lit(0)).when(value >= hi, last).otherwise(inner).cast("int")


Ranges = dict[str, tuple[float, float]]


def _finite(df: DataFrame) -> Measures:
    def value(c):
        v = _present(df, c).cast("double")
        return F.when(F.abs(v) < float("inf"), v)

    return {"low": (lambda c: F.min(value(c)), "double"), "high": (lambda c: F.max(value(c)), "double")}


def _ranges(found: list) -> Ranges:
    return {r.feature: (r.low, r.high) for r in found if r.low is not None}


def value_ranges(df: DataFrame, columns: Sequence[str]) -> Ranges:
    """Least and greatest finite value per feature, brought to the driver: two numbers a column."""

    return _ranges(_per_feature(df, columns, _finite(df)).collect())


def bins_frame(spark, ranges: Ranges, bins: int) -> DataFrame:
    """``(feature, bin, lo, hi)`` of every bin; a single one for a constant feature."""
    rows = []
    for feature, (low, high) in ranges.items():
        width = (high - low) / bins
        count = bins if high > low else 1
        for i in range(count):
            top = low + width * (i + 1) if i < count - 1 else high
            rows.append((feature, i, low + width * i, top))
    return local_table(spark, "feature string, bin int, lo double, hi double", rows)


def bin_rows(df: DataFrame, ranges: Ranges, bins: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., feature, bin)`` per non-missing number, ranges folded in as literals."""
    cells = []
    for feature, (low, high) in ranges.items():
        value = _present(df, feature).cast("double")
        cell = F.when(value.isNotNull(), bin_of(value, F.lit(low), F.lit(high), bins))
        cells.append(cell.alias(feature))
    long = df.select(*keep, *cells).unpivot(list(keep), list(ranges), "feature", "bin")
    return long.where("bin is not null")


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 10, ranges: Ranges | None = None
) -> DataFrame:
    """Equal-width histogram ``(feature, bin, lo, hi, count)``, empty bins included.

    ``ranges`` defaults to the ranges found in the data.
    """
    ranges = value_ranges(df, columns) if ranges is None else ranges
    frame = bins_frame(df.sparkSession, ranges, bins)
    if not ranges:
        return frame.withColumn("count", F.lit(0).cast("bigint"))
    counted = bin_rows(df, ranges, bins).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    return frame.join(counted, ["feature", "bin"], "left").select(
        "feature", "bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def string_stats(
    df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None
) -> DataFrame:
    """Unique values and average length per feature."""
    counts = string_counts(df, columns) if counts is None else counts
    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_unique"),
        (F.sum(F.length("value") * F.col("count")) / F.sum("count")).alias("avg_len"),
    )


def top_values(
    df: DataFrame, columns: Sequence[str], k: int = 20, counts: DataFrame | None = None
) -> DataFrame:
    """The ``k`` most frequent values per feature, ties by value.

    The rank filter cuts each task's rows to ``k`` per feature before the shuffle. Where
    that leaves many, a first round in hashed parts of a feature cuts them again.
    """
    counts = string_counts(df, columns) if counts is None else counts
    order = [F.desc("count"), F.asc("value")]
    if k > 100:
        part = Window.partitionBy("feature", F.pmod(F.hash("value"), F.lit(64))).orderBy(*order)
        counts = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    by = Window.partitionBy("feature").orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def rank_histogram(
    df: DataFrame, columns: Sequence[str], ranks: int = 1000, counts: DataFrame | None = None
) -> DataFrame:
    """Frequencies in rank order, first ``ranks`` ranks."""
    top = top_values(df, columns, ranks, counts)
    return top.select("feature", "rank", "value", "count")


def _first_scan(df: DataFrame, columns: list[str], numeric: list[str], probs: list[float], by: str | None) -> list:
    """Scalars, finite ranges and sketched quantiles of every column: one row per feature (and value of ``by``)."""

    def only_numbers(make, kind):
        return lambda c: make(c) if c in numeric else F.lit(None).cast(kind)

    measures = {
        **_common(df),
        **{m: (only_numbers(make, t), t) for m, (make, t) in {**_numeric(df), **_finite(df)}.items()},
        "sketch": (
            only_numbers(lambda c: F.percentile_approx(_present(df, c).cast("double"), probs, ACCURACY), "array<double>"),
            "array<double>",
        ),
    }
    aggs = [make(c).cast(t).alias(f"{m}__{i}") for i, c in enumerate(columns) for m, (make, t) in measures.items()]
    structs = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}__{i}").alias(m) for m in measures]) for i, c in enumerate(columns)
    ]
    keys = [F.col(by).alias("side")] if by else []
    found = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs).withColumn("side", F.lit(None).cast("string"))
    return found.select("side", F.explode(F.array(*structs)).alias("f")).select("side", "f.*").collect()


def _text_counts(df: DataFrame, strings: list[str], by: str | None) -> DataFrame:
    """``(side, feature, value, count)`` of strings."""
    side = F.col(by) if by else F.lit(None).cast("string")
    return (
        df.select(side.alias("__of"), *[F.col(c).cast("string").alias(c) for c in strings])
        .unpivot(["__of"], strings, "feature", "value")
        .where("value is not null")
        .groupBy(F.col("__of").alias("side"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _brackets(sketched: Sequence[float], parts: int) -> list[tuple]:
    """Ranges of values that hold the wanted ranks, from quantiles a margin below and above each."""
    lows, highs = list(sketched[: parts + 1]), list(sketched[parts + 1 :])
    lows[0], highs[-1] = float("-inf"), float("inf")
    return _merged(list(zip(lows, highs)))


def _wanted(n: int, parts: int) -> dict[int, tuple[int, float]]:
    """Per quantile the rank below it, and how far it lies from there to the next."""
    return {q: (q * (n - 1) // parts, q * (n - 1) % parts / parts) for q in range(parts + 1)}


_KEY = "__key"


def _sides_key(feature: Column, side: Column) -> Column:
    return F.concat(feature, F.lit("/"), F.coalesce(side.cast("string"), F.lit("")))


def feature_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 10,
    top: int = 20,
    sketch: bool = False,
    by: str | None = None,
) -> DataFrame:
    """Statistics record per feature: common counts, and a ``num`` or ``str`` struct.

    Three scans whatever the columns: one for scalars, ranges and sketches, one that counts histogram cells and the
    values inside the brackets of wanted quantiles, and one that counts the values of strings. With ``by``, a column of few
    values such as the two sides of a comparison, one record per value of it, from the same scans, and that column in front.
    Rows that are dear to derive are better written down first.
    """
    columns = [c for c in (columns or df.columns) if c != by]
    numeric, strings = split_kinds(df, columns)
    spark = df.sparkSession
    parts = 2 * bins  # they hold both the bin limits and the median
    grid = [q / parts for q in range(parts + 1)]
    margin = 2 / ACCURACY
    probs = grid if sketch else [max(0.0, p - margin) for p in grid] + [min(1.0, p + margin) for p in grid]
    found = _first_scan(df, columns, numeric, probs, by)
    kind = dict(df.dtypes)[by] if by else "string"
    sides = {str(i): r for i, r in enumerate(dict.fromkeys(r.side for r in found))}
    number = {side: i for i, side in sides.items()}
    head = "__side string, feature string, n_rows bigint, n_present bigint"
    out = _with_presence(
        local_table(spark, head, [(number[r.side], r.feature, r.n_rows, r.n_present) for r in found])
    ).withColumn("type", F.when(F.col("feature").isin(numeric), "numeric").otherwise("string"))
    numbers = [r for r in found if r.feature in numeric]
    # a side is known by its number from here on
    numbered = df
    if by:
        which = F.lit(None).cast("string")
        for i, side in sides.items():
            which = F.when(F.col(by).eqNullSafe(F.lit(side).cast(kind)), F.lit(i)).otherwise(which)
        numbered = df.withColumn("__side", which)
    limits = {
        (number[r.side] if by else None, r.feature): (
            r.low, r.high, [(float("-inf"), float("-inf"))] if sketch else _brackets(r.sketch, parts)
        )
        for r in numbers if r.n_present
    }
    which = "__side" if by else None

    def kept(counted: DataFrame, label: str) -> DataFrame:
        written = materialize(counted, label)
        return (written if by else written.withColumn("side", F.lit("0"))).withColumnRenamed("side", "__side")

    if numeric:
        cells = _number_cells(numbered, limits, bins, which).groupBy("side", "feature", "bin", "region", "value")
        counts = kept(cells.agg(F.sum("count").alias("count")), "cells")
    on = ["__side", "feature"]
    if numeric:
        num = local_table(
            spark,
            "__side string, feature string, min double, max double, mean double, std double, zeros bigint",
            [(number[r.side], r.feature, r.min, r.max, r.mean, r.std, r.zeros) for r in numbers],
        )
        frames = []
        for r in numbers:
            if r.low is not None:
                width, n = (r.high - r.low) / bins, bins if r.high > r.low else 1
                frames += [
                    (number[r.side], r.feature, i, r.low + width * i, r.low + width * (i + 1) if i < n - 1 else r.high)
                    for i in range(n)
                ]
        frame = local_table(spark, "__side string, feature string, bin int, lo double, hi double", frames)
        binned = counts.where("bin is not null").groupBy(*on, "bin").agg(F.sum("count").alias("count"))
        cell = F.struct("lo", "hi", F.coalesce(F.col("count"), F.lit(0)).cast("double").alias("count"))
        hist = frame.join(binned, [*on, "bin"], "left").groupBy(*on).agg(F.array_sort(F.collect_list(cell)).alias("std_hist"))
        values = _quantile_values(counts, numbers, number, parts, sketch, numbered if by else df, by is not None)
        grids = [
            (number[r.side], r.feature, values[number[r.side], r.feature]) for r in numbers if r.n_present
        ]
        rows = [(s, f, q, v) for s, f, vs in grids for q, v in enumerate(vs)]
        listed = (
            local_table(spark, "__side string, feature string, q int, value double", rows)
            .groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("g"))
            .select(
                *on,
                F.transform(F.filter("g", lambda s: s["q"] % 2 == 0), lambda s: s["value"]).alias("quantiles"),
                F.get("g", F.lit(bins))["value"].alias("median"),
            )
        )
        num = reduce(lambda a, b: a.join(b, on, "left"), [num, hist, listed]).select(
            *on,
            F.struct("min", "max", "mean", "std", "zeros", "median", "std_hist", "quantiles").cast(NUM).alias("num"),
        )
        out = out.join(num, on, "left")
    if strings:
        texts = kept(_text_counts(numbered, strings, which), "texts")
        texts = texts.withColumn(_KEY, _sides_key(F.col("feature"), F.col("__side")))
        keyed = texts.drop(*on).withColumnRenamed(_KEY, "feature")
        tops = (
            top_values(df, strings, top, keyed)
            .groupBy("feature")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "count"))).alias("t"))
            .select(
                F.col("feature").alias(_KEY),
                F.transform("t", lambda s: F.struct(s["value"].alias("value"), s["count"].alias("count"))).alias("top"),
            )
        )
        strs = string_stats(df, strings, keyed).withColumnRenamed("feature", _KEY).join(tops, _KEY, "left").select(
            _KEY, F.struct("n_unique", "avg_len", "top").cast(STR).alias("str")
        )
        out = out.withColumn(_KEY, _sides_key(F.col("feature"), F.col("__side"))).join(strs, _KEY, "left").drop(_KEY)
    if by:
        back = F.lit(None).cast(kind)
        for i, side in sides.items():
            back = F.when(F.col("__side") == i, F.lit(side).cast(kind)).otherwise(back)
        out = out.select(back.alias(by), *[c for c in out.columns if c != "__side"])
    return out.drop("__side")


def _quantile_values(
    counts: DataFrame, numbers: list, number: dict, parts: int, sketch: bool, df: DataFrame, sided: bool
) -> dict[tuple[str, str], list[float]]:
    """``(side, feature) -> quantiles``, from the counted brackets."""
    present = [r for r in numbers if r.n_present]
    if sketch:
        return {(number[r.side], r.feature): list(r.sketch) for r in present}
    if not present:
        return {}
    ranks = {}
    for r in present:
        spans = _wanted(r.n_present, parts).values()
        ranks[f"{r.feature}/{number[r.side]}"] = {k for below, rest in spans for k in ({below, below + 1} if rest else {below})}
    cells = counts.where("region is not null").groupBy(
        _sides_key(F.col("feature"), F.col("__side")).alias(_KEY), "region", "value"
    ).agg(F.sum("count").alias("count"))
    sliced = slice_in_order(cells, [_KEY, "region", "value"], unique=True)
    found = {(r[_KEY], r["rank"]): r["value"] for r in pick_ranks(sliced, "value", "count", _KEY, ranks).collect()}
    missed = {key for (key, _), v in found.items() if v is None}
    for r in present:
        key = f"{r.feature}/{number[r.side]}"
        if key in missed:
            # a bracket that does not hold its rank: all values of the feature are ordered
            rows = df.where(F.col("__side") == number[r.side]) if sided else df
            again = _pick(rows, {r.feature: [(float("-inf"), float("inf"))]}, {r.feature: ranks[key]})
            found.update({(key, rank): v for (_, rank), v in again.items()})
    out = {}
    for r in present:
        key, values = f"{r.feature}/{number[r.side]}", []
        for below, rest in _wanted(r.n_present, parts).values():
            low = found[key, below]
            values.append(low + (found[key, below + 1] - low) * rest if rest else low)
        out[number[r.side], r.feature] = values
    return out


def presence_and_values(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``stats_common`` with each feature's ``type``, and ``string_counts`` of the string features, from one scan."""
    columns = list(columns or df.columns)
    numeric, strings = split_kinds(df, columns)
    none = F.lit(None).cast("string")
    cells = [F.struct(F.lit("").alias("feature"), none.alias("value"))]
    for c in columns:
        value = none if c in numeric else F.col(c).cast("string")
        cells.append(F.when(_present(df, c).isNotNull(), F.struct(F.lit(c).alias("feature"), value.alias("value"))))
    long = df.select(F.explode(F.array(*cells)).alias("c")).where("c is not null").select("c.*")
    counts = materialize(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count")), "counts")
    held = {r.feature: r.n for r in counts.groupBy("feature").agg(F.sum("count").alias("n")).collect()}
    rows = [(c, held.get("", 0), held.get(c, 0), "numeric" if c in numeric else "string") for c in columns]
    common = local_table(df.sparkSession, "feature string, n_rows bigint, n_present bigint, type string", rows)
    return _with_presence(common), counts.where("value is not null").select("feature", "value", "count")


def save_stats(stats: DataFrame, path: str) -> None:
    """Keep a statistics record."""
    stats.write.mode("overwrite").parquet(path)


def load_stats(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
