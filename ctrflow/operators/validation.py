"""Data schema inferred from statistics, and the anomalies of new data against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def infer_schema(stats: DataFrame) -> DataFrame:
    """``(feature, type, min_presence, jsd_threshold)`` from ``feature, type, presence``."""
    return stats.select(
        "feature", "type", F.col("presence").alias("min_presence"), F.lit(None).cast("double").alias("jsd_threshold")
    )


def infer_domain(counts: DataFrame) -> DataFrame:
    """``(feature, value)``: every value of every string feature, from ``feature, value, count``."""
    return counts.select("feature", "value").distinct()


def listed_domain(schema: DataFrame, domain: DataFrame, at_most: int = 100) -> DataFrame:
    """For display only: adds ``domain``, the sorted values of features that have few of them."""
    few = domain.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= at_most)
    listed = (
        domain.join(F.broadcast(few.select("feature")), "feature", "left_semi")
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("value")).alias("domain"))
    )
    return schema.join(listed, "feature", "left")


def with_threshold(schema: DataFrame, feature: str, jsd: float) -> DataFrame:
    """Attach a drift threshold to one feature."""
    return schema.withColumn(
        "jsd_threshold", F.when(F.col("feature") == feature, F.lit(jsd)).otherwise(F.col("jsd_threshold"))
    )


def out_of_domain(counts: DataFrame, domain: DataFrame) -> DataFrame:
    """Values outside their feature's domain, of any size: ``(feature, n_values, n_rows)``."""
    # one row per feature: a schema is as wide as the table
    known = F.broadcast(domain.select("feature").distinct())
    return (
        counts.join(known, "feature", "left_semi")
        .join(domain, ["feature", "value"], "left_anti")
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("count").alias("n_rows"))
    )


def validate(
    stats: DataFrame, schema: DataFrame, counts: DataFrame | None = None, domain: DataFrame | None = None
) -> DataFrame:
    """Anomalies ``(feature, anomaly)`` of new statistics against a schema.

    ``column_missing``, ``new_column``, ``type_changed``, ``presence_low`` and
    ``out_of_domain``; a feature may have several.
    """
    new = stats.select("feature", F.col("type").alias("new_type"), "presence", F.lit(True).alias("in_new"))
    old = schema.select("feature", "type", "min_presence", F.lit(True).alias("in_old"))
    both = new.join(old, "feature", "full")
    checks = F.array(
        F.when(F.col("in_new").isNull(), F.lit("column_missing")),
        F.when(F.col("in_old").isNull(), F.lit("new_column")),
        F.when(F.col("new_type") != F.col("type"), F.lit("type_changed")),
        F.when(F.col("presence") < F.col("min_presence"), F.lit("presence_low")),
    )
    found = both.select("feature", F.explode(F.array_compact(checks)).alias("anomaly"))
    if counts is not None and domain is not None:
        found = found.unionByName(
            out_of_domain(counts, domain).select("feature", F.lit("out_of_domain").alias("anomaly"))
        )
    return found


def join_stats_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two statistics records side by side, a feature of either side kept."""
    def named(df, side):
        return df.select("feature", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "feature"])
    return named(left, "ref").join(named(right, "new"), "feature", "full")
