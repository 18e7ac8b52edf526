"""All queries of this package. Importing the modules registers them."""

from ctrflow.llm import (  # noqa: F401
    collocations,
    decontamination,
    divergence,
    language,
    licence_query,
    mixing,
    nearest,
    quality,
    secrets_query,
    sharding,
    similarity,
    substrings,
    tokenization,
)
from ctrflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
