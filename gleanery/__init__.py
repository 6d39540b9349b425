"""Spark-native engine for curating, de-duplicating and scoring records."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to executors by value, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
