"""Spark-native analytics for electricity-grid and market time series."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
