"""Sinks: typed feature tables with column roles, manifests, events, landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrflow.operators.columns import pack_event
from ctrflow.operators.sampling import shuffle_within_partition
from ctrflow.schema import CtrSchema


def typed_features(
    df: DataFrame, schema: CtrSchema, keep: Sequence[str] = (), real: str = "float"
) -> DataFrame:
    """Features in fixed order and types, each column's role kept in its metadata."""
    types = schema.feature_types(real)
    return df.select(
        *keep,
        *[
            F.col(c).cast(types[c]).alias(c, metadata={"role": schema.role(c)})
            for c in schema.feature_columns
        ],
    )


def write_features(
    df: DataFrame,
    path: str,
    schema: CtrSchema,
    keep: Sequence[str] = (),
    shuffle_seed: int | None = None,
    real: str = "float",
) -> None:
    """Write typed features; with a seed, in repeatable random order within partitions."""
    out = typed_features(df, schema, keep, real)
    if shuffle_seed is not None:
        out = shuffle_within_partition(out, out.columns, shuffle_seed)
    out.write.mode("overwrite").parquet(path)


def manifest(written: DataFrame) -> DataFrame:
    """Rows per file of a written table."""
    return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType) -> None:
    spark.read.schema(schema).option("header", True).csv(src).write.mode("overwrite").parquet(dst)


def to_events(scored: DataFrame, schema: CtrSchema, score: str = "predval") -> DataFrame:
    """One JSON message per scored row, in the column ``payload``."""
    event = pack_event(schema.conts, schema.cats, schema.label, score)
    return scored.select(*schema.key, F.to_json(event, {"ignoreNullFields": "false"}).alias("payload"))


def land_full(spark: SparkSession, src: str, dst: str) -> None:
    """First landing: the base area is written anew."""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)


def land_incremental(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType | None = None
) -> None:
    """Later landings: each source file is added once, however often this is run."""
    schema = schema or spark.read.parquet(src).schema
    query = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .parquet(src)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(dst)
    )
    query.awaitTermination()


def land(
    spark: SparkSession, src: str, dst: str, mode: str, checkpoint: str | None = None
) -> None:
    if mode == "full":
        land_full(spark, src, dst)
    elif mode == "incremental":
        land_incremental(spark, src, dst, checkpoint or dst.rstrip("/") + "_checkpoint")
    else:
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
