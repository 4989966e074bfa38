"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors by value, so that a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
