"""Query of the language operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.frames import crc_mod, table
from ctrflow.llm.langmix import fit, identify
from ctrflow.llm.registry import query


@query("op6_language")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit(docs.where(crc_mod("doc_id", 3) != 1))
    found = identify(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "langs", "weights"
    )
