"""Card-transaction analytics on Spark: clean, profile, correlate, cluster, flag."""

import sys

from pyspark import cloudpickle

from fraudspark.config import PipelineConfig

# The helpers travel inside the tasks, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["PipelineConfig"]
