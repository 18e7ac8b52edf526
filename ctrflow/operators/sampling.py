"""Limits, repeatable shuffles, unions, file and version choice."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.functions.scalars import base_name, path_part, version_number


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order; each task keeps ``n`` rows at most."""
    return df.orderBy(*order).limit(n)


def shuffle_within_partition(df: DataFrame, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Repeatable random order inside each partition; moves no row to another one."""
    return df.sortWithinPartitions(F.xxhash64(*key, F.lit(seed)))


def union_frames(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column that one lacks is null there."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select("*") for f in frames]
    )


def sample_one_file(df: DataFrame, seed: int = 0) -> DataFrame:
    """One file of a file-backed frame, chosen by a seeded hash of its path."""
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.orderBy(F.xxhash64("file", F.lit(seed)), "file").limit(1)


def artifact_versions(paths: DataFrame, path: str = "path") -> DataFrame:
    """Model and version number from ``.../<model>/<version>/<file>`` paths."""
    p = F.col(path)
    return paths.withColumn("model", path_part(p, 3)).withColumn(
        "version", version_number(path_part(p, 2))
    ).withColumn("file", base_name(p))


def latest_version(log: DataFrame) -> DataFrame:
    """Highest version per model by number, its path, and the next version."""
    return log.groupBy("model").agg(
        F.max("version").alias("version"), F.max_by("path", "version").alias("path")
    ).withColumn("next_version", F.col("version") + 1)
