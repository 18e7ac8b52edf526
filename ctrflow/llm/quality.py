"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.fm import fit, score
from ctrflow.llm.frames import crc_mod, table
from ctrflow.llm.registry import query

THRESHOLD = 0.7


@query("op7_quality")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    machine = fit(docs, table(spark, sf, "labels"), "quality", crc_mod("doc_id", 4) != 2)
    return score(docs, machine, keep=["doc_id"]).select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
