"""Tidewater: user-level data operators for PySpark.

Every operator is a lazy function from DataFrames and parameters to a
DataFrame.  Nothing here sets a master or starts a server; the caller owns the
session.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
