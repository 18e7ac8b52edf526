"""Event streams: reading, publishing, transforming and draining files."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ctrflow.operators.columns import parse_events
from ctrflow.operators.workflow import FittedWorkflow
from ctrflow.scratch import delete_path, exists

_FILE = "__file"

#: What a reader takes for a pattern in a path.
_GLOB = re.compile(r"([\\*?\[\]{}])")

MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("model_key", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)


def read_messages(
    spark: SparkSession,
    source: str,
    schema: T.StructType = MESSAGE,
    file_format: str = "json",
    max_files: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of raw messages: a directory of files, or Kafka by ``kafka:<topic>``.

    ``max_files`` bounds what one batch takes in, so a slow consumer holds back intake;
    for Kafka set ``maxOffsetsPerTrigger`` in ``options``.
    """
    reader = spark.readStream.options(**(options or {}))
    if source.startswith("kafka:"):
        raw = reader.format("kafka").option("subscribe", source[len("kafka:"):]).load()
        return raw.select(
            F.col("offset").alias("event_id"),
            F.col("key").cast("string").alias("model_key"),
            F.col("timestamp").alias("ts"),
            F.col("value").cast("string").alias("payload"),
        )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(schema).format(file_format).load(source)


def read_events(spark: SparkSession, source: str, **kwargs) -> DataFrame:
    """Stream of decoded prediction events."""
    return parse_events(read_messages(spark, source, **kwargs))


def publish(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write a stream of messages as JSON files."""
    return (
        events.writeStream.format("json")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def transform_stream(
    rows: DataFrame, workflow: FittedWorkflow, path: str, checkpoint: str, keep=(), **trigger
) -> StreamingQuery:
    """Apply a saved workflow to arriving rows, batch by batch; ``read_transformed`` reads the results.

    A batch is a table of its own, so values that are frequent in it are found before large vocabularies are
    joined. A batch that is played again replaces what it wrote.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        workflow.transform(df, keep).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_transformed(spark: SparkSession, path: str) -> DataFrame:
    """What ``transform_stream`` has written."""
    return spark.read.parquet(path).drop("batch_id")


def drain(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType,
    interval: str | None = None,
    max_files: int | None = None,
    delete: Callable[[SparkSession, str], None] = delete_path,
) -> StreamingQuery:
    """Move arriving Parquet files to ``dst``, polling every ``interval``; ``read_drained`` reads them there.

    The stream is one of file names, so that a file without rows is drained too. Per batch: the names of its files are
    written down, their rows copied to the batch's own folder, and then the files deleted. A batch that is played
    again after a failure copies anew if the copy was not whole, and else only deletes what is left of its
    files, so each row is moved once.
    """
    log = f"{checkpoint.rstrip('/')}/drained"

    def batch(df: DataFrame, batch_id: int) -> None:
        files, copy = f"{log}/{batch_id}", f"{dst}/batch_id={batch_id}"
        named = spark.read.schema(f"{_FILE} string")
        # a batch has a bounded number of files
        if not exists(spark, f"{copy}/_SUCCESS"):
            df.write.mode("overwrite").parquet(files)
            paths = [_GLOB.sub(r"\\\1", r[0]) for r in named.parquet(files).toLocalIterator()]
            if paths:
                reader = spark.read.schema(schema)
                reader = reader if _GLOB.search(src) else reader.option("basePath", src)
                reader.parquet(*paths).write.mode("overwrite").parquet(copy)
        with ThreadPoolExecutor(16) as pool:
            for _ in pool.map(lambda r: delete(spark, r[0]), named.parquet(files).toLocalIterator()):
                pass
        delete_path(spark, f"{log}/{batch_id - 1}")

    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = reader.load(src).select(F.col("path").alias(_FILE))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_drained(spark: SparkSession, dst: str, schema: T.StructType) -> DataFrame:
    """The rows that ``drain`` has moved."""
    moved = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(moved).parquet(dst).drop("batch_id")


def listen(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query and stop it after ``timeout`` seconds; whether it ended by itself."""
    if timeout is None:
        query.awaitTermination()
        return True
    ended = query.awaitTermination(timeout)
    if not ended:
        query.stop()
    return bool(ended)
