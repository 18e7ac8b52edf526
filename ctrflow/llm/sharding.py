"""Query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.frames import table
from ctrflow.llm.registry import query
from ctrflow.llm.shards import shard_documents

SHARDS = 24


@query("op2_shards")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    placed = shard_documents(table(spark, sf, "documents"), SHARDS, keep=["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
