"""Operators for training-data preparation: scans, deduplication, text extraction, tokens.

Nothing else in the library imports this subpackage. Functions that run in tasks travel to
the executors by value, so only NumPy, Arrow and the standard library must be there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
