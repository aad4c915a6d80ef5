"""Operators for building training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get the helpers with the function that uses them, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
