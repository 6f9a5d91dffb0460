"""Risk, data-quality and customer analytics as PySpark operators."""

import sys

from pyspark import cloudpickle

# Functions for Arrow batches travel to the executors whole, so that only the driver needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
