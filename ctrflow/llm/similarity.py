"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from ctrflow.llm.frames import table
from ctrflow.llm.jaccard import link_groups
from ctrflow.llm.registry import query

WORDS, SIMILARITY = 3, Fraction(9, 10)


@query("op5_jaccard")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return link_groups(docs, keep=["doc_id"], n=WORDS, threshold=SIMILARITY).select(
        "doc_id", "n_shingles", "component_id"
    )
