"""Scans: day files, new files, directories, listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.functions.scalars import DAY_FILE, base_name, day_of_file
from ctrflow.schema import CtrSchema

def read_days(
    spark: SparkSession,
    path: str,
    days: Iterable[int] | None = None,
    schema: CtrSchema = CtrSchema(),
) -> DataFrame:
    """Day files of a directory, with the day number taken from their names.

    With ``days`` only those files are opened, and one that is missing is an error. Files
    of other names are left out; a day number too large to be one is an error.
    """
    reader = spark.read.schema(schema.raw_type())
    if days is None:
        raw = reader.option("pathGlobFilter", "day_*.parquet").parquet(path)
    else:
        raw = reader.parquet(*[f"{path.rstrip('/')}/{DAY_FILE % day}" for day in days])
    day = day_of_file(base_name(F.col("_metadata.file_path")))
    return raw.withColumn(schema.day, day).where(F.col(schema.day).isNotNull())


def count_days(df: DataFrame, day: str = "day") -> DataFrame:
    """Number of days present. Days are few, and are reduced to one row each per task."""
    return df.agg(F.count_distinct(day).alias("days"))


def day_split(
    df: DataFrame, n_train: int, n_val: int, day: str = "day", check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Days ``[0, n_train)`` and ``[n_train, n_train + n_val)``.

    On a table partitioned by day the filters prune directories.
    """
    last = n_train + n_val
    if min(n_train, n_val) < 0:
        raise ValueError("numbers of days must not be negative")
    if check:
        # where days are folders, the listing knows them and no file is read
        have = df.where(F.col(day).between(0, last - 1)).select(day).distinct().count()
        if have < last:
            raise ValueError(f"asked for {last} days, found {have} of them")
    train = df.where((F.col(day) >= 0) & (F.col(day) < n_train))
    valid = df.where((F.col(day) >= n_train) & (F.col(day) < last))
    return train, valid


def scan_new(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """All Parquet files of a directory of newly landed data."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All CSV files of a directory, headers in the first line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def list_files(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Names and sizes of the files below a path; their content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
        .orderBy("path")
    )
    return files if limit is None else files.limit(limit)
