"""Spark-native analytics for labelled text corpora."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
