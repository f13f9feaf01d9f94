"""Operators of a training-data pipeline, one module for each."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that these need
# no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
