"""Operators for training-data pipelines."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the Python workers by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
