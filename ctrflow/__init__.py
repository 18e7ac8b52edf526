"""ctrflow: click-log features, data validation and live model monitoring as Spark jobs."""

import sys

from pyspark import cloudpickle

from ctrflow.schema import CtrSchema

# Functions that run inside tasks travel with them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CtrSchema"]
