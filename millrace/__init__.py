"""Distributed data preparation, mining and model evaluation on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors may not have this package installed: ship the functions that run
# inside tasks by value instead of by module name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
