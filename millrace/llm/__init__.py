"""Operators for preparing language-model training data; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
