"""Spark-native engine for gridded environmental observations and training-data preparation."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel with their code, so the package needn't be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
