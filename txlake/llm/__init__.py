"""Operators for training-data pipelines.  Nothing else in the package imports this.

Functions of this subpackage that run inside tasks are pickled by value, so a
job needs no copy of the package on its executors."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
