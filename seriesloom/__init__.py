"""Time-series profiling, features and forecasting over Spark tables of many series."""

import sys

from pyspark import cloudpickle

from .panel import Panel

__all__ = ["Panel"]

# Functions run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
