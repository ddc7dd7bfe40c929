"""Operators for preparing training data. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
