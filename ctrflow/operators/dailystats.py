"""Daily statistics records that can be merged for any span of days without reading rows.

A record holds, per day and feature, exact counts, sums and extremes, a KLL sketch of a number's values, an HLL sketch of
a string's distinct values, and its most frequent values as a summary (``operators.heavy``). Sums add up, sketches merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ctrflow.operators import heavy
from ctrflow.operators.statistics import _common, _numeric, _present, split_kinds

#: KLL accuracy: a quantile's rank is off by at most RANK_ERROR of the rows (99 % of the time).
KLL, RANK_ERROR = 1024, 0.005
#: HLL accuracy: 2 ** LG_K registers; distinct counts are off by at most DISTINCT_ERROR (three deviations).
LG_K, DISTINCT_ERROR = 14, 0.025
#: Values per string feature, day and task that a summary holds.
HELD = 2_000


def _measures(df: DataFrame, numeric: list[str]):
    """Per output name, how it is computed for a column, its type, and how two records' values become one."""

    def num(make):
        return lambda c: make(c) if c in numeric else F.lit(None)

    def text(make):
        return lambda c: F.lit(None) if c in numeric else make(c)

    scalars = {m: (num(make), t) for m, (make, t) in _numeric(df).items() if m in ("min", "max", "zeros")}
    return {
        "type": (lambda c: F.max(F.lit("numeric" if c in numeric else "string")), "string"),
        **_common(df),
        **scalars,
        "sum": (num(lambda c: F.sum(_present(df, c).cast("double"))), "double"),
        "squares": (num(lambda c: F.sum(_present(df, c).cast("double") * _present(df, c).cast("double"))), "double"),
        "values": (num(lambda c: F.kll_sketch_agg_double(_present(df, c).cast("double"), F.lit(KLL))), "binary"),
        "chars": (text(lambda c: F.sum(F.length(F.col(c).cast("string")))), "bigint"),
        "distinct": (text(lambda c: F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K))), "binary"),
    }


_MERGED = {
    "type": F.max, "n_rows": F.sum, "n_present": F.sum, "min": F.min, "max": F.max, "zeros": F.sum, "sum": F.sum, "squares": F.sum,
    "values": F.kll_merge_agg_double, "chars": F.sum, "distinct": F.hll_union_agg,
}


def daily_records(df: DataFrame, columns: Sequence[str] | None = None, day: str = "day") -> DataFrame:
    """One record per day and feature, from one scan; the frequent values of strings take a second one.

    ``(day, feature, type, n_rows, n_present, min, max, zeros, sum, squares, values, chars, distinct, frequent)``; what does not
    apply to a feature's type is null. Rows without a day are left out.
    """
    columns = [c for c in (columns or df.columns) if c != day]
    numeric, strings = split_kinds(df, columns)
    rows = df.where(F.col(day).isNotNull())
    measures = _measures(df, numeric)
    aggs = [make(c).cast(t).alias(f"{m}__{i}") for i, c in enumerate(columns) for m, (make, t) in measures.items()]
    structs = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}__{i}").alias(m) for m in measures]) for i, c in enumerate(columns)
    ]
    key = F.col(day).cast("bigint").alias("day")
    out = rows.groupBy(key).agg(*aggs).select("day", F.explode(F.array(*structs)).alias("f")).select("day", "f.*")
    none = F.lit(None).cast("array<struct<value: string, count: bigint>>")
    if not strings:
        return out.withColumn("frequent", none)
    kept = heavy.summaries(rows.withColumnRenamed(day, "day"), strings, HELD, "day")
    listed = kept.groupBy("day", "feature").agg(F.collect_list(F.struct("value", "count")).alias("frequent"))
    return out.join(listed, ["day", "feature"], "left")


def save_days(records: DataFrame, path: str) -> None:
    """Add records, a folder per day; a day that is there already is replaced."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def load_days(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The records of a span of days, both ends included; only their folders are read."""
    out = spark.read.parquet(path)
    if first is not None:
        out = out.where(F.col("day") >= first)
    return out if last is None else out.where(F.col("day") <= last)


def merge_days(records: DataFrame, *by: str) -> DataFrame:
    """One record per feature (and ``by``) from those of several days; the result can be merged again."""
    merged = records.groupBy(*by, "feature").agg(*[how(c).alias(c) for c, how in _MERGED.items()])
    entries = records.select(*by, "feature", F.explode("frequent").alias("e")).select(*by, "feature", "e.*")
    # the summaries of a day hold a bounded number of values, and so does their union over days
    listed = heavy.merge(entries, *by).groupBy(*by, "feature").agg(
        F.collect_list(F.struct("value", "count")).alias("frequent")
    )
    return merged.join(listed, [*by, "feature"], "left")


def describe(record: DataFrame, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """What a record says: ``feature, n_rows, n_present, mean, std, min, max, zeros, quantiles, n_unique, avg_len``.

    Counts, sums and extremes are exact. A quantile's rank is off by ``RANK_ERROR`` of the rows at most, ``n_unique``
    by ``DISTINCT_ERROR`` of itself.
    """
    present = F.col("n_present")
    mean = F.when(present > 0, F.col("sum") / present)
    spread = F.greatest(F.col("squares") / present - mean * mean, F.lit(0.0))
    at = F.array(*[F.lit(float(p)) for p in probs])
    return record.select(
        "feature", "n_rows", "n_present", mean.alias("mean"), F.when(mean.isNotNull(), F.sqrt(spread)).alias("std"),
        "min", "max", "zeros",
        F.when((F.col("type") == "numeric") & (present > 0), F.kll_sketch_get_quantile_double("values", at)).alias("quantiles"),
        F.when(F.col("type") == "string", F.hll_sketch_estimate("distinct")).alias("n_unique"),
        F.when(present > 0, F.col("chars") / present).alias("avg_len"),
    )


def frequent(record: DataFrame, k: int = 20) -> DataFrame:
    """``(feature, rank, value, low, high)``: the ``k`` values with the greatest lower bounds, and bounds of their counts."""
    entries = record.select("feature", F.explode("frequent").alias("e")).select("feature", "e.*")
    off = entries.where("value is null").select("feature", F.col("count").alias("off"))
    order = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc("value"))
    top = entries.where("value is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(F.broadcast(off), "feature").select(
        "feature", "rank", "value", F.col("count").alias("low"), (F.col("count") + F.col("off")).alias("high")
    )
