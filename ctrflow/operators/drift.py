"""Distribution drift of numeric features: Jensen-Shannon divergence, log base 2.

With p and q the bin shares and m their mean, JSD = (sum p log2(p/m) + sum q log2(q/m)) / 2,
an empty term counting 0. Missing values take no part. The value lies in [0, 1].
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.operators.statistics import bin_rows, bins_frame, value_ranges


def paired_histograms(
    a: DataFrame, b: DataFrame, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """Histograms of both sides over their joint range: ``(feature, bin, n_ref, n_new)``.

    One scan of both sides for the ranges, one for the counts. Two counters per feature and
    bin leave each task.
    """
    both = a.select(*columns, F.lit(True).alias("__ref")).unionByName(
        b.select(*columns, F.lit(False).alias("__ref"))
    )
    ranges = value_ranges(both, columns)
    frame = bins_frame(a.sparkSession, ranges, bins).select("feature", "bin")
    if not ranges:
        return frame.withColumns({n: F.lit(0).cast("bigint") for n in ("n_ref", "n_new")})
    counted = (
        bin_rows(both, ranges, bins, ["__ref"])
        .groupBy("feature", "bin")
        .agg(F.count_if("__ref").alias("n_ref"), F.count_if(~F.col("__ref")).alias("n_new"))
    )
    return frame.join(counted, ["feature", "bin"], "left").na.fill(0, ["n_ref", "n_new"])


def _divergence(paired: DataFrame) -> DataFrame:
    """``(feature, value)`` from per-cell masses ``n_ref`` and ``n_new``."""
    of_feature = Window.partitionBy("feature")  # as many rows as it has cells
    p = F.col("n_ref") / F.sum("n_ref").over(of_feature)
    q = F.col("n_new") / F.sum("n_new").over(of_feature)

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / ((x + y) / 2))).otherwise(0.0)

    held = (F.sum("n_ref").over(of_feature) > 0) & (F.sum("n_new").over(of_feature) > 0)
    shares = paired.withColumn("__held", held).withColumns(
        {"__p": F.when(F.col("__held"), p), "__q": F.when(F.col("__held"), q)}
    )
    return (
        shares.where("__held")
        .groupBy("feature")
        .agg(
            (
                (F.sum(term(F.col("__p"), F.col("__q"))) + F.sum(term(F.col("__q"), F.col("__p"))))
                / 2
            ).alias("value")
        )
    )


def js_divergence(
    a: DataFrame, b: DataFrame, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """Divergence per numeric feature between two datasets; none where a side has no values."""
    return _divergence(paired_histograms(a, b, columns, bins))


def rebin(ref: DataFrame, new: DataFrame) -> DataFrame:
    """Two saved histograms ``(feature, lo, hi, count)`` on the union of their bin edges.

    Each bin is spread evenly over the cells it overlaps. A bin of width zero goes whole
    into the cell that holds it, the feature's highest edge having a cell of its own then.
    """
    sides = ref.select("feature", "lo", "hi", "count", F.lit("ref").alias("side")).unionByName(
        new.select("feature", "lo", "hi", "count", F.lit("new").alias("side"))
    )
    edges = sides.select("feature", F.explode(F.array("lo", "hi")).alias("c_lo")).distinct()
    order = Window.partitionBy("feature").orderBy("c_lo")  # two edges per histogram bin
    top = sides.where("lo = hi").select("feature", F.col("lo").alias("c_lo")).distinct()
    points = (
        edges.groupBy("feature").agg(F.max("c_lo").alias("c_lo"))
        .join(top, ["feature", "c_lo"], "left_semi")
        .select("feature", "c_lo", F.col("c_lo").alias("c_hi"))
    )
    cells = (
        edges.withColumn("c_hi", F.lead("c_lo").over(order))
        .where("c_hi is not null")
        .unionByName(points)
    )
    overlap = F.least("hi", "c_hi") - F.greatest("lo", "c_lo")
    spread = F.when(F.col("hi") > F.col("lo"), F.col("count") * overlap / (F.col("hi") - F.col("lo")))
    point = (F.col("hi") == F.col("lo")) & (
        ((F.col("c_lo") <= F.col("lo")) & (F.col("lo") < F.col("c_hi")))
        | ((F.col("c_lo") == F.col("lo")) & (F.col("c_hi") == F.col("lo")))
    )
    mass = F.coalesce(spread, F.when(point, F.col("count").cast("double")), F.lit(0.0))
    return (
        cells.join(sides, "feature")
        .where((F.col("lo") < F.col("c_hi")) & (F.col("hi") > F.col("c_lo")) | point)
        .groupBy("feature", "c_lo", "c_hi")
        .agg(
            F.sum(F.when(F.col("side") == "ref", mass).otherwise(0.0)).alias("n_ref"),
            F.sum(F.when(F.col("side") == "new", mass).otherwise(0.0)).alias("n_new"),
        )
    )


def saved_histograms(stats: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The histograms inside a statistics record as ``(feature, lo, hi, count)``."""
    out = stats.where("num is not null").select("feature", F.explode("num.std_hist").alias("h"))
    out = out.select("feature", "h.lo", "h.hi", "h.count")
    return out.where(F.col("feature").isin(list(columns))) if columns else out


def js_from_stats(
    ref: DataFrame, new: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Divergence per feature from two saved statistics records."""
    return _divergence(rebin(saved_histograms(ref, columns), saved_histograms(new, columns)))


def drift_report(divergence: DataFrame, schema: DataFrame) -> DataFrame:
    """``(feature, measure, value, threshold, drift)`` for every feature with a threshold.

    A value equal to the threshold is drift.
    """
    limits = schema.where("jsd_threshold is not null").select("feature", F.col("jsd_threshold").alias("threshold"))
    return divergence.join(limits, "feature").select(
        "feature",
        F.lit("jensen_shannon").alias("measure"),
        "value",
        "threshold",
        (~(F.col("value") < F.col("threshold"))).alias("drift"),
    )
