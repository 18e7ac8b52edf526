"""All registered queries. Importing the modules registers them."""

from ctrflow.plans import (  # noqa: F401
    features,
    files,
    models,
    monitoring,
    quality,
    streams,
    tables,
)
from ctrflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
