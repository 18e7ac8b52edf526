"""Query of the byte-level BPE operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ctrflow.llm.bpe import encode, read_ranks
from ctrflow.llm.frames import table
from ctrflow.llm.registry import query


@query("op8_bpe")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf, "documents")
    return encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], with_ids=False)
