"""Operators of a training-data pipeline over documents and pages.

Nothing else in the library imports this subpackage. Its task functions travel to the executors by value, so
the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
