"""Operators that prepare text corpora for training."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel whole: a cluster need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
