"""Spark operators for cleaning, profiling and modelling record tables."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
