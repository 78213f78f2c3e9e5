"""tripwire: transaction fraud scoring on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Python workers get this package's functions and classes by value, so nothing
# needs to be installed on the executors (``--py-files`` works as well).
_cloudpickle.register_pickle_by_value(sys.modules[__name__])
