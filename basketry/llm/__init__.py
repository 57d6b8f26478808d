"""Operators for preparing training data; nothing else in the library imports this subpackage.

Their functions travel to the executors by value, so no executor needs this library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
