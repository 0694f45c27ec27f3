"""Operators for preparing training text, and their queries.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
