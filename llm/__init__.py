"""Operators for preparing training data; each module holds one operator."""

import sys

from pyspark import cloudpickle

# Workers get this package's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
